"""Registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.llm import oracles

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

PATTERN = public_tokenizers.PATTERN


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@register("op2_minmax_near_dedup", oracles.NEAR_DUPLICATES)
def op2(spark, sf_dir):
    from fieldcraft.llm.minmax import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@register("op3_byte_bpe")
def op3(spark, sf_dir):
    from fieldcraft.llm.bpe import encode_decode, rank_file_json
    file = rank_file_json(public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN)
    return encode_decode(table(spark, sf_dir, "documents"), file)


@register("op4_best_fit_packing")
def op4(spark, sf_dir):
    from fieldcraft.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), PATTERN)


@register("op1_interleaved_shards", oracles.SHARDS)
def op1(spark, sf_dir):
    from fieldcraft.llm.sharding import interleave
    return interleave(table(spark, sf_dir, "documents"))


PROBE = "</s>[INST] ok [/INST]"


@register("op6_chat_format", r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(length(regexp_replace(text, '([<\[\\])', '\1\1', 'g'))
      + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 END)::BIGINT AS formatted_chars,
  (array_agg(role ORDER BY turn, role, text)[1] IN ('system', 'user')
   AND array_agg(role ORDER BY turn, role, text)[-1] = 'assistant'
   AND regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' ELSE 'a' END, ''
                                    ORDER BY turn, role, text), 's?(ua)+')) AS valid
FROM c GROUP BY conv_id""")
def op6(spark, sf_dir):
    from fieldcraft.llm.chat import conversation_digests, format_conversations
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    return conversation_digests(format_conversations(conv.unionByName(probe)))


@register("op7_ngram_ratio_quality")
def op7(spark, sf_dir):
    from fieldcraft.llm.quality import judge
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op5_vantage_point_search", """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20""")
def op5(spark, sf_dir):
    from fieldcraft.llm.ann import nearest
    return nearest(table(spark, sf_dir, "embeddings"))


@register("op8_host_path_extraction")
def op8(spark, sf_dir):
    from fieldcraft.llm.html import main_text
    return main_text(table(spark, sf_dir, "pages"))


@register("op9_string_kernel_language")
def op9(spark, sf_dir):
    from fieldcraft.llm.langid import predict
    return predict(table(spark, sf_dir, "documents"))


@register("op10_warc_round_trip", """
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h AS fh, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, url, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, (5 * (j // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (j % 4))::INT) & 31)::INT, 1)
    FOR j IN range(32)], '') AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p JOIN f ON h = fh""")
def op10(spark, sf_dir):
    from fieldcraft.llm.warc import round_trip
    return round_trip(table(spark, sf_dir, "pages"))

#: the rules of the url query: host, path, verdict
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@register("op11_url_range_rules", r"""
WITH r AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) t(h, p, v)),
u AS (SELECT row_number() OVER () AS n, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
k AS (SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
w AS (SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM k JOIN r ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM k LEFT JOIN w USING (n)""")
def op11(spark, sf_dir):
    from fieldcraft.llm.urls import judge_urls
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@register("op12_token_alignment")
def op12(spark, sf_dir):
    from fieldcraft.llm.align import align
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return align(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), PATTERN, model)


@register("op13_target_resampling", oracles.RESAMPLE)
def op13(spark, sf_dir):
    from fieldcraft.llm.resample import resample
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)

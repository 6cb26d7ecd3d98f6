"""Multi-valued operators over the documents table: long cells (up to
thousands of tokens) and a vocabulary that grows with the corpus. Labelled
documents are the training rows, ``quality`` is the label."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldcraft.operators import encode as E
from fieldcraft.operators import target as T
from fieldcraft.plans.common import round_doubles
from fieldcraft.plans.registry import ORACLE, register
from fieldcraft.sources import fixtures as fx

THRESHOLD = 100
_DOCS = """
WITH d AS (SELECT d.doc_id, d.text, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
tk AS (SELECT doc_id, quality, unnest(string_split(text, ' ')) AS tok FROM d)"""


def _docs(spark, d):
    labels = fx.table(spark, d, "labels").select("doc_id", "quality")
    return fx.table(spark, d, "documents").select("doc_id", "text").join(labels, "doc_id", "left")


@register("doc_token_noisy_or")
def doc_token_noisy_or(spark, d):
    docs = _docs(spark, d)
    return round_doubles(T.token_noisy_or(docs, "text", "doc_id", F.col("quality").isNotNull(), ["doc_id"],
                                          label="quality"))


ORACLE["doc_token_noisy_or"] = _DOCS + """,
st AS (SELECT tok, count(*) AS cnt, sum(CASE WHEN quality > 0 THEN 1 ELSE 0 END) AS pos FROM tk
       WHERE quality IS NOT NULL GROUP BY tok),
ls AS (SELECT doc_id, sum(ln(1 - (pos + 1.0) / (cnt + 2.0))) AS s FROM tk JOIN st USING (tok) WHERE pos > 0 GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text = '-1' THEN -1.0 ELSE round(exp(coalesce(s, 0)), 6) END AS text_score
FROM d LEFT JOIN ls USING (doc_id)
"""


@register("doc_token_vocab")
def doc_token_vocab(spark, d):
    spec = [E.FieldSpec("text", "multi")]
    counts = E.value_counts_all(_docs(spark, d), spec)
    return E.frequency_vocab(counts, spec, THRESHOLD).select("value", "cnt", "idx")


ORACLE["doc_token_vocab"] = _DOCS + f""",
g AS (SELECT tok AS value, count(*) AS cnt FROM tk GROUP BY tok HAVING count(*) >= {THRESHOLD})
SELECT value, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, value) AS INT) AS idx
FROM g WHERE coalesce(TRY_CAST(value AS DOUBLE), 1) <> 0
"""

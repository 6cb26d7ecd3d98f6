"""DuckDB SQL of the corpus queries that takes more than a few lines."""

from __future__ import annotations

#: CRC-32 of UTF-8 bytes: the table from its rule, and the checksum of a text
CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
    FROM (SELECT unnest(range(256)) AS i)))"""


def crc32(text: str) -> str:
    """CRC-32 of a text column, in a query that joins the one row of ``crc_table``."""
    return (f"xor(list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT), "
            "lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1]), 4294967295), 4294967295)")


#: A-Z in lower case
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SHARDS = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, source, coalesce(octet_length(encode(text)), 0) + 1 AS size,
        {crc32("coalesce(text, '')")} AS text_crc32,
        md5(concat_ws('/', 'fieldcraft', doc_id)) AS key
      FROM documents, crc_table),
r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, text_crc32, size) - 0.5::DOUBLE)
        / count(*) OVER (PARTITION BY source) AS fraction FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST, key, doc_id NULLS FIRST, text_crc32, size) - 1 AS pos,
        count(*) OVER () AS n FROM r)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (pos * 16 // n)::INT AS shard,
  pos - ((pos * 16 // n) * n + 15) // 16 AS slot, NULL::INT AS grown_shard, source
FROM p
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex({LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT r, doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
x AS (SELECT r, doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.r, b.r, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM x a JOIN x b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
e AS (SELECT a, b FROM p WHERE 100 * shared >= 75 * (na + nb - shared) AND a IS NOT NULL AND b IS NOT NULL),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT DISTINCT doc_id AS d, doc_id AS c FROM s WHERE doc_id IS NOT NULL
          UNION SELECT l.b, reach.c FROM reach JOIN l ON l.a = reach.d WHERE reach.c < l.b),
k AS (SELECT d, min(c) AS c FROM reach GROUP BY d)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, c AS component_id, coalesce(doc_id = c, true) AS kept FROM s LEFT JOIN k ON doc_id = d
"""

RESAMPLE = rf"""
WITH {CRC_TABLE},
texts AS (SELECT 'd' AS side, row_number() OVER () AS n, doc_id, text FROM documents
          UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
w AS (SELECT side, n, doc_id, list_filter(string_split_regex({LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM texts),
f AS (SELECT side, n, unnest(ws) AS feature FROM w
      UNION ALL SELECT side, n, unnest(list_transform(range(1, greatest(len(ws), 1)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w),
c AS (SELECT side, n, feature, count(*) AS k FROM f GROUP BY ALL),
h AS (SELECT feature, {crc32("feature")} % 10000 AS bucket
      FROM (SELECT DISTINCT feature FROM c), crc_table),
b AS (SELECT bucket, sum(k) FILTER (WHERE side = 'd') AS s, sum(k) FILTER (WHERE side = 'b') AS t FROM c JOIN h USING (feature) GROUP BY bucket),
tot AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM b),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000) / ((coalesce(s, 0) + 1.0::DOUBLE) * (t_all + 10000))))::BIGINT AS gain
      FROM b, tot),
d AS (SELECT n, sum(k)::BIGINT AS n_features, floor(sum(k * gain) / sum(k))::BIGINT AS weight
      FROM c JOIN h USING (feature) JOIN g USING (bucket) WHERE side = 'd' GROUP BY n),
r AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        ('0x' || substr(sha256('7:' || coalesce(w.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS u
      FROM w LEFT JOIN d USING (n) WHERE side = 'd'),
s AS (SELECT *, weight + floor(-1000 * ln(-ln((u + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
        count(*) OVER (PARTITION BY n_words >= 20) AS many FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * many // 100 THEN place END AS rank FROM k
"""

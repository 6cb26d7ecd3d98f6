"""Join, projection, split and file-format queries (J, P, S, U, O rows)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcraft.operators import prep as P
from fieldcraft.plans.common import is_train, log, merged, round_doubles
from fieldcraft.plans.registry import register
from fieldcraft.session import scratch_path
from fieldcraft.sources import files as S
from fieldcraft.sources import fixtures as fx

SCORE_SQL = "round((row_id * 7919 % 1000) / 1000.0, 6)"


def synthetic_score(row_id="row_id"):
    """A deterministic score in [0, 1) with ties: (row_id*7919 % 1000)/1000."""
    return ((F.col(row_id) * 7919) % 1000 / F.lit(1000.0))


# ------------------------------------------------------------------ J01 / P01-P04 / U01
@register("merged_table", sql="""
SELECT * EXCLUDE (kw1, label), CASE WHEN split = 'test' THEN 0 ELSE label END AS label FROM m
""")
def merged_table(spark, d):
    lg = log(spark, d)
    train = lg.filter(F.col("split") != "test")
    test = lg.filter(F.col("split") == "test")
    return P.merge_splits(train, test, fx.ad(spark, d), fx.usr(spark, d), kind=0, drop_user=["kw1"])


@register("merged_table_all", sql="SELECT * FROM m WHERE split <> 'test'")
def merged_table_all(spark, d):
    lg = log(spark, d)
    return P.merge_splits(lg.filter(F.col("split") != "test"), None, fx.ad(spark, d),
                          fx.usr(spark, d), kind=1)


# ------------------------------------------------------------------ J02 / P03
@register("merged_left", sql="""
SELECT l.*, coalesce(a.campaignId, '-1') AS campaignId, coalesce(a.advertiserId, '-1') AS advertiserId,
       coalesce(a.creativeSize, -1) AS creativeSize, coalesce(a.adkw, '-1') AS adkw,
       coalesce(u.lbs, -1) AS lbs, coalesce(u.gender, '-1') AS gender,
       coalesce(u.ability, -1) AS ability, coalesce(u.kw1, '-1') AS kw1
FROM log l LEFT JOIN ad a USING (aid) LEFT JOIN usr u USING (uid)
""")
def merged_left(spark, d):
    out = P.merge_tables(log(spark, d), fx.ad(spark, d), fx.usr(spark, d), how="left")
    return P.fill_missing(out)


# ------------------------------------------------------------------ S03 / S05 / P14
@register("csv_roundtrip", sql=f"SELECT *, {SCORE_SQL} AS score FROM m")
def csv_roundtrip(spark, d):
    m = merged(spark, d).withColumn("score", synthetic_score())
    path = scratch_path(spark, "csv")
    S.write_csv(m, path, "%.6f")
    cols = sorted(c for c in m.columns if c != "label") + ["label"]
    schema = T.StructType([m.schema[c] for c in cols])
    return round_doubles(S.read_csv(spark, path, schema))


# ------------------------------------------------------------------ P05
@register("label_recode", sql="""
, raw AS (SELECT row_id, CAST(label AS VARCHAR) AS lab_str, 2 * label - 1 AS lab_pm,
                 CASE split WHEN 'train' THEN label WHEN 'valid' THEN -1 ELSE -2 END AS lab_sent FROM log)
SELECT row_id, CASE WHEN lab_str = '1' THEN 1 ELSE 0 END AS r_str,
       CASE WHEN lab_pm = -1 THEN 0 ELSE lab_pm END AS r_pm,
       CASE WHEN lab_sent IN (-1, -2) THEN 0 ELSE lab_sent END AS r_sent
FROM raw
""")
def label_recode(spark, d):
    raw = log(spark, d).select(
        "row_id", F.col("label").cast("string").alias("lab_str"), (2 * F.col("label") - 1).alias("lab_pm"),
        F.when(F.col("split") == "train", F.col("label")).when(F.col("split") == "valid", -1)
         .otherwise(-2).alias("lab_sent"))
    return raw.select("row_id", P.recode_label_str("lab_str").alias("r_str"),
                      P.recode_label_pm("lab_pm").alias("r_pm"),
                      P.recode_label_sentinel("lab_sent").alias("r_sent"))


# ------------------------------------------------------------------ P09 / O04
@register("positional_split", sql="""
, p AS (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS pos, count(*) OVER () AS n FROM log)
SELECT row_id, CASE WHEN pos < floor(0.7 * n) THEN 'head' ELSE 'tail' END AS part
FROM p WHERE pos < floor(0.7 * n) OR pos >= n - floor(0.3 * n)
""")
def positional_split(spark, d):
    return P.positional_split(log(spark, d).select("row_id"), "row_id")


# ------------------------------------------------------------------ P10
@register("stratified_split", sql="""
, h AS (SELECT row_id, label, (row_id * 2654435761 + 2018) % 4294967296 AS h FROM log),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, row_id) - 1 AS r,
             count(*) OVER (PARTITION BY label) AS nl FROM h)
SELECT row_id, label, CASE WHEN r < ceil(nl * 0.2) THEN 'test' ELSE 'train' END AS part FROM r
""")
def stratified_split(spark, d):
    return P.stratified_split(log(spark, d).select("row_id", "label"), "row_id", "label", 0.2, 2018)


# ------------------------------------------------------------------ S04 / O05
@register("bounded_scan", sql="SELECT row_id, uid, aid, label FROM log ORDER BY row_id LIMIT 500")
def bounded_scan(spark, d):
    return P.bounded_scan(log(spark, d).select("row_id", "uid", "aid", "label"), "row_id", 500)


# ------------------------------------------------------------------ S10 / J05
@register("positional_attach", sql=f"SELECT row_id, uid, aid, {SCORE_SQL} AS score FROM log")
def positional_attach(spark, d):
    lg = log(spark, d)
    path = scratch_path(spark, "scorecol")
    (lg.orderBy("row_id").select(F.format_string("%.6f", synthetic_score()).alias("s"))
       .write.mode("overwrite").csv(path))  # headerless single column, line order = row order
    vals = S.read_lines_with_position(spark, path, T.StructType([T.StructField("score", T.DoubleType())]))
    return round_doubles(S.attach_by_position(lg.select("row_id", "uid", "aid"), "row_id", vals))


# ------------------------------------------------------------------ S01 / S02 / S13
def _profile(spark, d):
    path = scratch_path(spark, "profile")
    S.write_profile_text(fx.usr(spark, d), path, "uid", ["lbs", "gender", "ability", "kw1"],
                         multi=["kw1"])
    return S.read_profile(spark, path)


@register("profile_scan", sql="""
SELECT uid, 'lbs' AS key, CAST(lbs AS VARCHAR) AS vals FROM usr
UNION ALL SELECT uid, 'gender', gender FROM usr
UNION ALL SELECT uid, 'ability', CAST(ability AS VARCHAR) FROM usr
UNION ALL SELECT uid, 'kw1', kw1 FROM usr WHERE kw1 <> '-1'
""")
def profile_scan(spark, d):
    return S.profile_long(_profile(spark, d))


@register("max_token_len", sql="""
SELECT 'uid' AS key, CAST(1 AS BIGINT) AS max_len
UNION ALL SELECT 'lbs', 1 UNION ALL SELECT 'gender', 1 UNION ALL SELECT 'ability', 1
UNION ALL SELECT 'kw1', CAST(max(len(string_split(kw1, ' '))) AS BIGINT) FROM usr WHERE kw1 <> '-1'
""")
def max_token_len(spark, d):
    return S.profile_max_len(_profile(spark, d))


@register("profile_wide", sql="""
SELECT uid, CAST(ability AS VARCHAR) AS ability, gender,
       CASE WHEN kw1 = '-1' THEN '0' ELSE kw1 END AS kw1, CAST(lbs AS VARCHAR) AS lbs
FROM usr
""")
def profile_wide(spark, d):
    prof = _profile(spark, d).cache()
    keys = [r["key"] for r in S.profile_max_len(prof).collect()]  # one row per key (the columns)
    return S.profile_wide(prof, keys)

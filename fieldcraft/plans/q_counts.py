"""Aggregation, ordered-row and token queries (A, W, F, P08, E01, E02, E07)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from fieldcraft.operators import counts as C
from fieldcraft.operators import ordered as O
from fieldcraft.plans.common import is_train, KEEP, log, merged, round_doubles
from fieldcraft.plans.registry import register
from fieldcraft.sources import fixtures as fx

THRESHOLD = 100
WS_LEN = "CASE WHEN kw1 = '-1' THEN 0 ELSE len(string_split_regex(trim(kw1), '\\s+')) END"


# ------------------------------------------------------------------ A01 / A02 / J03
@register("pair_count", sql="""
SELECT row_id, count(*) OVER (PARTITION BY aid, lbs) AS new_count_aid_lbs,
       count(*) OVER (PARTITION BY aid, gender) AS new_count_aid_gender FROM m
""")
def pair_count(spark, d):
    m = merged(spark, d).select("row_id", "aid", "lbs", "gender")
    out = C.group_count(C.group_count(m, ["aid", "lbs"]), ["aid", "gender"])
    return out.select("row_id", "new_count_aid_lbs", "new_count_aid_gender")


# ------------------------------------------------------------------ A03
@register("nunique_join", sql="""
, nu AS (SELECT campaignId, count(DISTINCT aid) AS campaignId_active_aid FROM m GROUP BY 1)
SELECT row_id, campaignId_active_aid FROM m JOIN nu USING (campaignId)
""")
def nunique_join(spark, d):
    m = merged(spark, d).select("row_id", "campaignId", "aid")
    return C.nunique_join(m, "campaignId", "aid", "campaignId_active_aid") \
            .select("row_id", "campaignId_active_aid")


# ------------------------------------------------------------------ A04 / E06
RECIPE = [("uid", "aid", "uid_to_aid"), ("uid", "campaignId", "uid_to_campaignId"),
          ("uid", "advertiserId", "uid_to_advertiserId"), ("uid", "creativeSize", "uid_to_creativeSize"),
          ("uid", "adkw", "uid_to_adkw"), ("campaignId", "aid", "campaignId_to_aid")]


def _z_sql(specs):
    ctes, sel = [], []
    for key, col, name in specs:
        ctes.append(f"{name}_n AS (SELECT {key}, count(DISTINCT {col}) AS c FROM m GROUP BY 1)")
        ctes.append(f"{name}_s AS (SELECT avg(c) AS mu, stddev_pop(c) AS sd FROM m JOIN {name}_n USING ({key}))")
        sel.append(f"(SELECT round((n.c - s.mu) / CASE WHEN s.sd = 0 THEN 1 ELSE s.sd END, 6) "
                   f"FROM {name}_n n, {name}_s s WHERE n.{key} = m.{key}) AS {name}")
    return ", " + ",\n".join(ctes) + "\nSELECT row_id, " + ",\n  ".join(sel) + " FROM m"


@register("nunique_zscore", sql=_z_sql(RECIPE[:1]))
def nunique_zscore(spark, d):
    m = merged(spark, d).select("row_id", "uid", "aid")
    return round_doubles(C.nunique_zscore(m, "uid", "aid", "uid_to_aid").select("row_id", "uid_to_aid"))


@register("nunique_recipe", sql=_z_sql(RECIPE))
def nunique_recipe(spark, d):
    m = merged(spark, d)
    out = C.nunique_recipe(m, RECIPE)
    return round_doubles(out.select("row_id", *[n for _, _, n in RECIPE]))


# ------------------------------------------------------------------ A09
@register("mean_by_key", sql="""
SELECT row_id, split,
  round(avg(ability) OVER (PARTITION BY aid), 6) AS aid_mean_ability,
  round(avg(ability) OVER (PARTITION BY campaignId), 6) AS campaignId_mean_ability,
  round(avg(ability) OVER (PARTITION BY advertiserId), 6) AS advertiserId_mean_ability
FROM m
""")
def mean_by_key(spark, d):
    m = merged(spark, d).select("row_id", "split", "aid", "campaignId", "advertiserId", "ability")
    out = C.mean_by_key(m, ["aid", "campaignId", "advertiserId"], "ability")
    return round_doubles(out.select("row_id", "split", "aid_mean_ability", "campaignId_mean_ability",
                                    "advertiserId_mean_ability"))


# ------------------------------------------------------------------ A05 / A06 / U01
@register("uid_aid_stats", sql="""
, cn AS (SELECT campaignId, count(DISTINCT aid) AS campaignId_aid_nunique FROM ad GROUP BY 1),
adst AS (SELECT aid, campaignId_aid_nunique FROM ad JOIN cn USING (campaignId)),
u AS (SELECT uid, count(DISTINCT aid) AS uid_aid_nunique, count(aid) AS uid_count FROM log GROUP BY 1),
a AS (SELECT aid, count(DISTINCT uid) AS aid_uid_nunique FROM log GROUP BY 1)
SELECT row_id, campaignId_aid_nunique, uid_aid_nunique, aid_uid_nunique, uid_count
FROM log LEFT JOIN u USING (uid) LEFT JOIN a USING (aid) LEFT JOIN adst USING (aid)
""")
def uid_aid_stats(spark, d):
    lg = log(spark, d).select("row_id", "split", "uid", "aid")
    parts = [lg.filter(F.col("split") == s) for s in ("train", "valid", "test")]
    out = C.uid_aid_stats(parts, fx.ad(spark, d))
    return out.select("row_id", "campaignId_aid_nunique", "uid_aid_nunique", "aid_uid_nunique", "uid_count")


# ------------------------------------------------------------------ A15
@register("uid_count_vocab", sql=f"""
, uc AS (SELECT uid, count(aid) AS uid_count FROM log GROUP BY uid),
t AS (SELECT l.row_id, uc.uid_count FROM log l JOIN uc USING (uid) WHERE l.split = 'train'),
g AS (SELECT uid_count, count(*) AS cnt, min(row_id) AS f FROM t GROUP BY 1 HAVING count(*) >= {THRESHOLD})
SELECT uid_count, cnt, CAST(row_number() OVER (ORDER BY f) + 1 AS INTEGER) AS idx FROM g
""")
def uid_count_vocab(spark, d):
    lg = log(spark, d).select("row_id", "split", "uid", "aid")
    parts = [lg.filter(F.col("split") == s) for s in ("train", "valid", "test")]
    st = C.uid_aid_stats(parts, fx.ad(spark, d))
    return C.first_seen_vocab(st.filter(is_train()), "uid_count", ["row_id"], THRESHOLD)


# ------------------------------------------------------------------ W01
@register("running_rank", sql="""
SELECT row_id, row_number() OVER (PARTITION BY uid ORDER BY row_id) AS uid_rank,
       row_number() OVER (PARTITION BY aid ORDER BY row_id) AS aid_rank FROM log
""")
def running_rank(spark, d):
    lg = log(spark, d).select("row_id", "uid", "aid")
    a = O.running_rank(lg, "uid", "row_id").select("row_id", "uid_rank")
    b = O.running_rank(lg, "aid", "row_id").select("row_id", "aid_rank")
    return a.join(b, "row_id")


# ------------------------------------------------------------------ W02 / A17 / F14
@register("dup_flags", sql="""
, g AS (SELECT uid, aid, count(*) AS n, min(row_id) AS lo, max(row_id) AS hi, count(label) AS nl
        FROM log GROUP BY ALL),
j AS (SELECT l.row_id, CASE WHEN n = 1 THEN 0 WHEN row_id = lo THEN 2 WHEN row_id = hi THEN 3 ELSE 1 END AS mb, nl
      FROM log l JOIN g USING (uid, aid))
SELECT row_id, CAST(mb = 0 AS TINYINT) AS maybe_0, CAST(mb = 1 AS TINYINT) AS maybe_1,
       CAST(mb = 2 AS TINYINT) AS maybe_2, CAST(mb = 3 AS TINYINT) AS maybe_3,
       CAST(nl > 2 AS INTEGER) AS large2 FROM j
""")
def dup_flags(spark, d):
    out = O.dup_flags(log(spark, d), ["uid", "aid"], "row_id")
    return out.select("row_id", "maybe_0", "maybe_1", "maybe_2", "maybe_3", "large2")


# ------------------------------------------------------------------ W03
def _lag(k):
    return f"CAST(lag(label, {k}) OVER w AS VARCHAR)"


@register("label_history_seq", sql=f"""
, tr AS (SELECT row_id, uid, label FROM log WHERE split = 'train'),
h AS (SELECT row_id, uid, concat_ws(' ', {_lag(4)}, {_lag(3)}, {_lag(2)}, {_lag(1)}) AS seq
      FROM tr WINDOW w AS (PARTITION BY uid ORDER BY row_id)),
voc AS (SELECT seq, CAST(row_number() OVER (ORDER BY min(row_id)) - 1 AS INTEGER) AS seq_idx FROM h GROUP BY seq),
lastk AS (SELECT uid, string_agg(CAST(label AS VARCHAR), ' ' ORDER BY row_id) AS seq
          FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY row_id DESC) AS rn FROM tr)
          WHERE rn <= 4 GROUP BY uid),
oth AS (SELECT l.row_id, l.split, coalesce(lastk.seq, '') AS seq FROM log l LEFT JOIN lastk USING (uid)
        WHERE l.split <> 'train'),
al AS (SELECT row_id, 'train' AS split, seq FROM h UNION ALL SELECT row_id, split, seq FROM oth)
SELECT al.row_id, al.split, al.seq, coalesce(voc.seq_idx, 0) AS seq_idx FROM al LEFT JOIN voc USING (seq)
""")
def label_history_seq(spark, d):
    lg = log(spark, d)
    return O.label_history_seq(lg.filter(is_train()), lg.filter(~is_train()), "uid", "row_id",
                               keep=KEEP).select("row_id", "split", "seq", "seq_idx")


# ------------------------------------------------------------------ P08 / A19
@register("rare_to_minus1", sql=f"""
, c AS (SELECT row_id, campaignId || '_' || CAST(lbs AS VARCHAR) AS v FROM m),
vc AS (SELECT v, count(*) AS n FROM c GROUP BY v)
SELECT row_id, CASE WHEN n < {THRESHOLD} THEN '-1' ELSE v END AS campaignId_lbs FROM c JOIN vc USING (v)
""")
def rare_to_minus1(spark, d):
    m = merged(spark, d).select("row_id", F.concat_ws("_", "campaignId", F.col("lbs").cast("string"))
                                .alias("campaignId_lbs"))
    return C.rare_to_minus1(m, "campaignId_lbs", THRESHOLD)


# ------------------------------------------------------------------ E02 / F01
CROSS_PAIRS = [("campaignId", "lbs"), ("advertiserId", "gender"), ("creativeSize", "ability")]


def _cross_sql(pairs):
    ctes, sel = [], []
    for a, b in pairs:
        n = f"{a}_{b}"
        ctes.append(f"{n}_v AS (SELECT row_id, CAST({a} AS VARCHAR) || '_' || CAST({b} AS VARCHAR) AS v FROM m)")
        ctes.append(f"{n}_r AS (SELECT row_id, CASE WHEN count(*) OVER (PARTITION BY v) < {THRESHOLD} "
                    f"THEN '-1' ELSE v END AS r FROM {n}_v)")
        ctes.append(f"{n}_e AS (SELECT row_id, dense_rank() OVER (ORDER BY r) - 1 AS e FROM {n}_r)")
        sel.append(f"{n}_e.e AS {n}")
    joins = " ".join(f"JOIN {a}_{b}_e USING (row_id)" for a, b in pairs)
    return ", " + ",\n".join(ctes) + "\nSELECT m.row_id, " + ", ".join(sel) + f" FROM m {joins}"


def _crossed(spark, d, pairs):
    m = merged(spark, d).select("row_id", *sorted({c for p in pairs for c in p}))
    return C.cross_encode(m, pairs, THRESHOLD).select("row_id", *[f"{a}_{b}" for a, b in pairs])


@register("cross_encode", sql=_cross_sql(CROSS_PAIRS))
def cross_encode(spark, d):
    return _crossed(spark, d, CROSS_PAIRS)


#: every pair of the single-valued columns
WIDE_PAIRS = list(combinations(["advertiserId", "aid", "campaignId", "creativeSize", "lbs", "gender", "ability", "uid"], 2))


@register("cross_encode_wide", sql=_cross_sql(WIDE_PAIRS))
def cross_encode_wide(spark, d):
    """Twenty-eight crosses, counted and numbered in one long form."""
    return _crossed(spark, d, WIDE_PAIRS)


# ------------------------------------------------------------------ E01
@register("label_encode", sql="""
SELECT row_id, dense_rank() OVER (ORDER BY creativeSize) - 1 AS creativeSize_le,
       dense_rank() OVER (ORDER BY campaignId) - 1 AS campaignId_le FROM m
""")
def label_encode(spark, d):
    m = merged(spark, d).select("row_id", "creativeSize", "campaignId")
    return C.label_encode(C.label_encode(m, "creativeSize"), "campaignId") \
            .select("row_id", "creativeSize_le", "campaignId_le")


# ------------------------------------------------------------------ F02
@register("pair_key", sql="SELECT row_id, kw1 || '|' || adkw AS pair_key FROM m")
def pair_key(spark, d):
    return merged(spark, d).select("row_id", F.concat_ws("|", "kw1", "adkw").alias("pair_key"))


# ------------------------------------------------------------------ W06
@register("pair_token_max", sql="""
, p AS (SELECT row_id, unnest(string_split(kw1, ' ')) AS x1, adkw FROM m),
p2 AS (SELECT row_id, x1, unnest(string_split(adkw, ' ')) AS x2 FROM p),
pp AS (SELECT row_id, x1 || '|' || x2 AS pair FROM p2),
c AS (SELECT pair, count(*) AS n FROM pp GROUP BY pair)
SELECT m.row_id, coalesce(max(n), 0) AS kw1_adkw_pair_max FROM m LEFT JOIN pp USING (row_id) LEFT JOIN c USING (pair)
GROUP BY m.row_id
""")
def pair_token_max(spark, d):
    m = merged(spark, d).select("row_id", "kw1", "adkw")
    return O.pair_token_max(m, "kw1", "adkw", "row_id", ["row_id"], right_sep=" ")


@register("pair_count_histogram", sql="""
, p AS (SELECT unnest(string_split(kw1, ' ')) AS x1, adkw FROM m),
pp AS (SELECT x1 || '|' || unnest(string_split(adkw, ' ')) AS pair FROM p),
c AS (SELECT pair, count(*) AS pair_count FROM pp GROUP BY pair)
SELECT pair_count, count(*) AS n_pairs FROM c GROUP BY pair_count
""")
def pair_count_histogram(spark, d):
    return O.pair_count_histogram(merged(spark, d).select("kw1", "adkw"), "kw1", "adkw", right_sep=" ")


# ------------------------------------------------------------------ A16 / A19
SUMMARY = ["label", "creativeSize", "lbs", "ability"]


@register("summary_table", sql=", t AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS x FROM m" for c in SUMMARY) + """)
SELECT "column", count(x) AS n, round(avg(x), 6) AS mean, round(stddev(x), 6) AS std, min(x) AS min, max(x) AS max
FROM t GROUP BY 1
""")
def summary_table(spark, d):
    return round_doubles(C.summary_table(merged(spark, d), SUMMARY))


@register("value_frequency", sql="""
SELECT campaignId, count(*) AS count FROM m GROUP BY campaignId
""")
def value_frequency(spark, d):
    return C.value_counts(merged(spark, d), "campaignId")


# ------------------------------------------------------------------ F04 / F06 / F07
@register("positional_tokens", sql="""
SELECT row_id, """ + ", ".join(
    f"coalesce(string_split(kw1, ' ')[{i + 1}], '-1') AS kw1_{i}" for i in range(5)) + """,
       CAST(len(list_distinct(string_split(kw1, ' '))) AS INTEGER) AS kw1_length FROM m
""")
def positional_tokens(spark, d):
    m = merged(spark, d).select("row_id", "kw1")
    return C.positional_tokens(m, "kw1").drop("kw1")


# ------------------------------------------------------------------ F05
@register("token_len_vocab", sql=f"""
, l AS (SELECT row_id, split, {WS_LEN} AS kw1_len FROM m),
g AS (SELECT kw1_len, count(*) AS cnt, min(row_id) AS f FROM l WHERE split = 'train'
      GROUP BY 1 HAVING count(*) >= {THRESHOLD}),
v AS (SELECT kw1_len, row_number() OVER (ORDER BY f) + 1 AS idx FROM g)
SELECT l.row_id, l.split, CAST(l.kw1_len AS INTEGER) AS kw1_len,
       CAST(coalesce(v.idx, 1) AS INTEGER) AS kw1_len_idx FROM l LEFT JOIN v USING (kw1_len)
""")
def token_len_vocab(spark, d):
    m = C.token_length(merged(spark, d).select("row_id", "split", "kw1"), "kw1")
    vals = m.filter(is_train()).withColumn("v", F.col("kw1_len").cast("string"))
    vocab = C.first_seen_vocab(vals, "v", ["row_id"], THRESHOLD)
    return C.value_vocab_lookup(m, "kw1_len", vocab, "v", "kw1_len_idx").select(
        "row_id", "split", "kw1_len", "kw1_len_idx")


# ------------------------------------------------------------------ A18
@register("token_count_by_uid", sql=f"""
SELECT uid, CAST(sum({WS_LEN}) AS BIGINT) AS kw1_count_byuid FROM m GROUP BY uid
""")
def token_count_by_uid(spark, d):
    return C.token_count_by_key(merged(spark, d), "uid", "kw1")


# ------------------------------------------------------------------ E07 / S06
@register("vocab_tokens", sql=f"""
, s AS (SELECT row_id, string_split_regex(trim(kw1), '\\s+') AS arr FROM m WHERE split = 'train'),
t AS (SELECT row_id, unnest(arr) AS token, unnest(range(1, len(arr) + 1)) AS p FROM s),
g AS (SELECT token, count(*) AS cnt, min(row_id * 1000000 + p) AS f FROM t GROUP BY token)
SELECT token, cnt, CAST(row_number() OVER (ORDER BY f) + 1 AS INTEGER) AS idx FROM g WHERE cnt >= {THRESHOLD}
""")
def vocab_tokens(spark, d):
    from fieldcraft.session import scratch_path
    from fieldcraft.sources import files as S
    path = scratch_path(spark, "features")
    S.write_feature_files(merged(spark, d), path, ["kw1"])        # per-split feature files (S06)
    return C.token_vocab(S.read_feature_files(spark, path, "train"), "kw1", "row_id", THRESHOLD)

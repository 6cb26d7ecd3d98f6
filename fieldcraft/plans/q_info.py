"""Information-score and binning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldcraft.functions.numeric import UID_CONVERT_EDGES, UID_COUNT_EDGES
from fieldcraft.operators import counts as C
from fieldcraft.operators import info as I
from fieldcraft.operators import target as T
from fieldcraft.plans.common import is_train, KEEP, log, merged
from fieldcraft.plans.registry import register
from fieldcraft.sources import fixtures as fx

PMI_ATTRS = ["lbs", "gender", "ability"]
WIDE_ATTRS = ["advertiserId", "campaignId", "creativeSize", "lbs", "gender", "ability", "uid", "adkw", "kw1"]
NUNIQUE_COLS = ["campaignId_aid_nunique", "uid_aid_nunique", "aid_uid_nunique"]


def _bucket(expr: str, src: str) -> str:
    return f"CAST(round(least({expr} - (SELECT min({expr}) FROM {src}), 1.5) * 10) AS INTEGER)"


def _pmi_sql(attrs):
    cols = ",\n  ".join(
        f"ln(1 + count(*) OVER (PARTITION BY {a}) * count(*) OVER (PARTITION BY aid) "
        f"/ count(*) OVER (PARTITION BY aid, {a}) / (SELECT n FROM nn)) AS new_inf_aid_{a}" for a in attrs)
    sel = ", ".join(f"{_bucket(f'new_inf_aid_{a}', 'x')} AS new_inf_aid_{a}" for a in attrs)
    return f"""
, nn AS (SELECT count(*) AS n FROM m),
x AS (SELECT row_id, {cols} FROM m)
SELECT row_id, {sel} FROM x
"""


@register("pmi_bucket", sql=_pmi_sql(PMI_ATTRS))
def pmi_bucket(spark, d):
    m = merged(spark, d).select("row_id", "aid", *PMI_ATTRS)
    return I.pmi_single(m, "aid", PMI_ATTRS).select("row_id", *[f"new_inf_aid_{a}" for a in PMI_ATTRS])


@register("pmi_bucket_wide", sql=_pmi_sql(WIDE_ATTRS))
def pmi_bucket_wide(spark, d):
    """Nine attributes from one count table."""
    m = merged(spark, d).select("row_id", "aid", *WIDE_ATTRS)
    return I.pmi_single(m, "aid", WIDE_ATTRS).select("row_id", *[f"new_inf_aid_{a}" for a in WIDE_ATTRS])


def _l1pe(s):
    return f"CASE WHEN {s} > 30 THEN {s} + ln(1 + exp(-{s})) ELSE ln(1 + exp({s})) END"


@register("pmi_tokens", sql=f"""
, nn AS (SELECT count(*) AS n FROM m),
t AS (SELECT row_id, aid, unnest(string_split_regex(trim(kw1), '\\s+')) AS tok FROM m),
b AS (SELECT tok, count(*) AS b FROM t GROUP BY tok),
ct AS (SELECT aid, tok, count(*) AS ct FROM t GROUP BY ALL),
cc AS (SELECT aid, count(*) AS cc FROM m GROUP BY aid),
p AS (SELECT t.row_id, cc.cc * b.b / ct.ct / (SELECT n FROM nn) AS p
      FROM t JOIN b USING (tok) JOIN ct USING (aid, tok) JOIN cc USING (aid)),
pr AS (SELECT row_id, sum(ln(p)) AS s, count(*) AS k, min(p) AS mn FROM p GROUP BY row_id),
x AS (SELECT m.row_id, {_l1pe('s')} AS mx, ({_l1pe('s')}) / k AS me, ln(1 + mn) AS mt
      FROM m LEFT JOIN pr USING (row_id))
SELECT row_id, {_bucket('mx', 'x')} AS new_inf_aid_kw1_max, {_bucket('me', 'x')} AS new_inf_aid_kw1_mean,
       {_bucket('mt', 'x')} AS new_inf_aid_kw1_mintok
FROM x
""")
def pmi_tokens(spark, d):
    m = merged(spark, d).select("row_id", "aid", "kw1")
    return I.pmi_tokens(m, "aid", "kw1")


def _stats(spark, d):
    lg = log(spark, d).select("row_id", "split", "uid", "aid")
    parts = [lg.filter(F.col("split") == s) for s in ("train", "valid", "test")]
    return C.uid_aid_stats(parts, fx.ad(spark, d))


STATS_SQL = """
, cn AS (SELECT campaignId, count(DISTINCT aid) AS campaignId_aid_nunique FROM ad GROUP BY 1),
adst AS (SELECT aid, campaignId_aid_nunique FROM ad JOIN cn USING (campaignId)),
u AS (SELECT uid, count(DISTINCT aid) AS uid_aid_nunique, count(aid) AS uid_count FROM log GROUP BY 1),
a AS (SELECT aid, count(DISTINCT uid) AS aid_uid_nunique FROM log GROUP BY 1),
st AS (SELECT row_id, split, uid, aid, campaignId_aid_nunique, uid_aid_nunique, aid_uid_nunique, uid_count
       FROM log LEFT JOIN u USING (uid) LEFT JOIN a USING (aid) LEFT JOIN adst USING (aid))"""


def _digit(col, edges_sql, n=7):
    """Number of edges strictly below the value; ``edges_sql`` is a list."""
    terms = " + ".join(f"CASE WHEN {col} > ({edges_sql})[{i + 1}] THEN 1 ELSE 0 END" for i in range(n))
    return f"CAST({terms} AS INTEGER)"


@register("digitize_percentile", sql=STATS_SQL + """,
q AS (SELECT """ + ", ".join(
    f"quantile_cont({c}, [0.0, 0.2, 0.35, 0.5, 0.65, 0.85, 1.0]) AS q_{c}" for c in NUNIQUE_COLS) + """ FROM st)
SELECT row_id, """ + ", ".join(f"{_digit(c, 'q_' + c)} AS {c}" for c in NUNIQUE_COLS) + """ FROM st, q
""")
def digitize_percentile(spark, d):
    st = _stats(spark, d).select("row_id", *NUNIQUE_COLS)
    return I.digitize_percentile(st, NUNIQUE_COLS)


@register("digitize_fixed", sql=STATS_SQL + f""",
tr AS (SELECT * FROM log WHERE split = 'train'),
pu AS (SELECT uid, sum(label) AS up, sum(1 - label) AS un FROM tr GROUP BY uid),
pp AS (SELECT uid, aid, max(label) AS hp, max(1 - label) AS hn FROM tr GROUP BY ALL),
j AS (SELECT l.row_id,
             coalesce(pu.up, 0) - CASE WHEN l.split = 'train' THEN coalesce(pp.hp, 0) ELSE 0 END AS p,
             coalesce(pu.un, 0) - CASE WHEN l.split = 'train' THEN coalesce(pp.hn, 0) ELSE 0 END AS n
      FROM log l LEFT JOIN pu USING (uid) LEFT JOIN pp USING (uid, aid)),
cv AS (SELECT row_id, CASE WHEN p + n > 0 THEN p / (p + n) ELSE -1.0 END AS uid_convert FROM j)
SELECT row_id, {_digit('uid_count', str(UID_COUNT_EDGES), len(UID_COUNT_EDGES))} AS uid_count_bin,
       {_digit('uid_convert', str([float(x) for x in UID_CONVERT_EDGES]), len(UID_CONVERT_EDGES))} AS uid_convert_bin
FROM st JOIN cv USING (row_id)
""")
def digitize_fixed(spark, d):
    st = _stats(spark, d).select("row_id", "uid_count")
    cv = T.user_conversion_loo(log(spark, d), KEEP, is_train()).select("row_id", "uid_convert")
    out = st.join(cv, "row_id")
    out = I.digitize_fixed(out, "uid_count", UID_COUNT_EDGES, "uid_count_bin")
    out = I.digitize_fixed(out, "uid_convert", UID_CONVERT_EDGES, "uid_convert_bin")
    return out.select("row_id", "uid_count_bin", "uid_convert_bin")

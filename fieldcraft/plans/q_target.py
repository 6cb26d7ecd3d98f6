"""Target-statistic queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from fieldcraft.operators import target as T
from fieldcraft.plans.common import is_train, KEEP, fpi_sql, log, merged, round_doubles
from fieldcraft.plans.registry import register

OOF_PAIRS = [("campaignId", "gender"), ("advertiserId", "lbs"), ("creativeSize", "ability")]
#: as many pairs as a full feature set crosses
SINGLE = ["advertiserId", "campaignId", "creativeSize", "lbs", "gender", "ability"]
WIDE_PAIRS = [*combinations(SINGLE, 2), ("aid", "gender")]


def _key_union(pairs, cols="row_id, split, label, fold", src="m"):
    def key(p):
        return "||'_'||".join(f"CAST({c} AS VARCHAR)" for c in p)
    return "\n  UNION ALL ".join(
        f"SELECT {cols}, '{'_'.join(p)}' AS pair, {key(p)} AS key FROM {src}" for p in pairs)


def _lfo_rows_sql(pairs):
    """Per (row, pair): sums/counts over training rows outside the row's fold
    (all training rows for non-training rows), computed directly."""
    return f"""
, k AS ({_key_union(pairs)}),
st AS (SELECT pair, key, fold, sum(label) AS s, count(*) AS n FROM k WHERE split = 'train' GROUP BY ALL),
r AS (SELECT k.row_id, k.split, k.label, k.fold, k.pair,
        sum(CASE WHEN k.split <> 'train' OR st.fold <> k.fold THEN st.s END) AS s,
        sum(CASE WHEN k.split <> 'train' OR st.fold <> k.fold THEN st.n END) AS n
      FROM k LEFT JOIN st USING (pair, key) GROUP BY ALL)"""


# ------------------------------------------------------------------ T01
_T01_STATS = """
, st AS (SELECT campaignId, gender, sum(label) AS s, count(*) AS n FROM m WHERE split = 'train' GROUP BY ALL)"""
_T01_ROWS = """
SELECT m.row_id, m.split,
       round(round(100 * coalesce((st.s + {a}) / (st.n + {a} + {b}), {a} / ({a} + {b})), 8), {digits}) AS campaignId_gender_stas
FROM m LEFT JOIN st USING (campaignId, gender){more}
WHERE m.split <> 'train'
"""
#: iterated priors differ in their last digits between two engines
FIT_DIGITS = 4


def _smoothed(spark, d, fit: bool):
    m = merged(spark, d)
    out = T.smoothed_rate(m.filter(is_train()), m.filter(~is_train()).select(*KEEP, "campaignId", "gender"),
                          ["campaignId", "gender"], "campaignId_gender_stas", fit_prior=fit)
    return round_doubles(out.select(*KEEP, "campaignId_gender_stas"), FIT_DIGITS if fit else 6)


@register("smoothed_ctr", sql=_T01_STATS + f"""
, hist AS (SELECT n::DOUBLE AS n, s::DOUBLE AS s, count(*)::DOUBLE AS m FROM st GROUP BY ALL),
pr AS (SELECT * FROM {fpi_sql("hist", None)})""" + _T01_ROWS.format(a="pr.a", b="pr.b", digits=FIT_DIGITS, more=", pr"))
def smoothed_ctr(spark, d):
    return _smoothed(spark, d, True)


@register("smoothed_ctr_fixed", sql=_T01_STATS + _T01_ROWS.format(a="1.0", b="1.0", digits=6, more=""))
def smoothed_ctr_fixed(spark, d):
    return _smoothed(spark, d, False)


# ------------------------------------------------------------------ T03 (+P06, P11)
def _oof_sql(fit: bool, pairs=OOF_PAIRS):
    sel = ",\n  ".join(
        f"round(max(CASE WHEN pair = '{'_'.join(p)}' THEN v END), {FIT_DIGITS if fit else 6}) AS {'_'.join(p)}_stas" for p in pairs)
    a, b, join, prior = "1.0", "1.0", "", ""
    if fit:
        a, b = "pr.a", "pr.b"
        join = " JOIN pr ON pr.g = r.pair || '/' || (CASE WHEN r.split = 'train' THEN r.fold ELSE -1 END)"
        prior = f""",
tot AS (SELECT pair, key, sum(s) AS s, sum(n) AS n FROM st GROUP BY ALL),
folds AS (SELECT DISTINCT pair, fold FROM st),
lfo AS (SELECT tot.pair, f.fold AS lk, tot.n - coalesce(st.n, 0) AS n, tot.s - coalesce(st.s, 0) AS s
        FROM tot JOIN folds f USING (pair) LEFT JOIN st ON st.pair = tot.pair AND st.key = tot.key AND st.fold = f.fold
        UNION ALL SELECT pair, -1 AS lk, n, s FROM tot),
hist AS (SELECT pair || '/' || lk AS g, n::DOUBLE AS n, s::DOUBLE AS s, count(*)::DOUBLE AS m FROM lfo WHERE n > 0 GROUP BY ALL),
pr AS (SELECT * FROM {fpi_sql("hist", "g")})"""
    return _lfo_rows_sql(pairs) + prior + f"""
SELECT row_id, split, label,
  {sel}
FROM (SELECT r.*, round(100 * CASE WHEN n > 0 THEN (s + {a}) / (n + {a} + {b}) ELSE {a} / ({a} + {b}) END, 8) AS v
      FROM r{join})
GROUP BY row_id, split, label
"""


@register("oof_smoothed_ctr", sql=_oof_sql(True))
def oof_smoothed_ctr(spark, d):
    out = T.oof_smoothed_rate(merged(spark, d), OOF_PAIRS, keep=["row_id", "split", "label"],
                              is_train=is_train(), fit_prior=True)
    return round_doubles(out, FIT_DIGITS)


@register("oof_smoothed_ctr_wide", sql=_oof_sql(True, WIDE_PAIRS))
def oof_smoothed_ctr_wide(spark, d):
    """All sixteen pairs, their statistics counted in one aggregation."""
    out = T.oof_smoothed_rate(merged(spark, d), WIDE_PAIRS, keep=["row_id", "split", "label"],
                              is_train=is_train(), fit_prior=True)
    return round_doubles(out, FIT_DIGITS)


@register("oof_smoothed_ctr_fixed", sql=_oof_sql(False))
def oof_smoothed_ctr_fixed(spark, d):
    out = T.oof_smoothed_rate(merged(spark, d), OOF_PAIRS, keep=["row_id", "split", "label"], is_train=is_train())
    return round_doubles(out)


# ------------------------------------------------------------------ T02
@register("beta_prior_fpi", sql=f"""
, st AS (SELECT campaignId, gender, fold, sum(label) AS s, count(*) AS n
         FROM m WHERE split = 'train' GROUP BY ALL),
tot AS (SELECT campaignId, gender, sum(s) AS s, sum(n) AS n FROM st GROUP BY ALL),
lfo AS (SELECT f.fold AS lk_fold, tot.n - coalesce(st.n, 0) AS n, tot.s - coalesce(st.s, 0) AS s
        FROM tot CROSS JOIN (SELECT DISTINCT fold FROM st) f
        LEFT JOIN st ON st.campaignId = tot.campaignId AND st.gender = tot.gender AND st.fold = f.fold
        UNION ALL SELECT -1 AS lk_fold, n, s FROM tot),
hist AS (SELECT lk_fold, CAST(n AS DOUBLE) AS n, CAST(s AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS m
         FROM lfo WHERE n > 0 GROUP BY ALL)
SELECT lk_fold, round(a, {FIT_DIGITS}) AS alpha, round(b, {FIT_DIGITS}) AS beta FROM {fpi_sql("hist", "lk_fold")}
""")
def beta_prior_fpi(spark, d):
    m = merged(spark, d)
    long = T._stack_keys(m.select("campaignId", "gender", "fold", "label", "split"),
                         [("campaignId", "gender")], ["fold", "label", "split"])
    stats = T.leave_fold_out_stats(long, ["pair", "key"], "fold", is_train())
    hist = T.leave_fold_out_histogram(stats)
    return round_doubles(T.beta_prior_fpi(hist, ["lk_fold"]), FIT_DIGITS)


# ------------------------------------------------------------------ T05
POSNEG_KEYS = ["uid", "aid"]


def _posneg_sql():
    pairs = [[k] for k in POSNEG_KEYS]
    sel = ",\n  ".join(
        f"CAST(max(CASE WHEN pair = '{k}' THEN CASE WHEN n > 0 THEN s ELSE -1 END END) AS BIGINT) AS {k}_positive_num,\n  "
        f"CAST(max(CASE WHEN pair = '{k}' THEN CASE WHEN n > 0 THEN n - s ELSE -1 END END) AS BIGINT) AS {k}_negative_num"
        for k in POSNEG_KEYS)
    return _lfo_rows_sql(pairs) + f"""
SELECT row_id, split, label,
  {sel}
FROM r GROUP BY row_id, split, label
"""


@register("oof_pos_neg", sql=_posneg_sql())
def oof_pos_neg(spark, d):
    m = merged(spark, d)
    return T.oof_pos_neg(m, POSNEG_KEYS, keep=["row_id", "split", "label"], is_train=is_train())


# ------------------------------------------------------------------ T06 / A11 / P12
def _contig_sql(value: str) -> str:
    return f"""
, tr AS (SELECT row_id, kw1, label, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM m WHERE split = 'train'),
nn AS (SELECT count(*) AS ntr, count(*) // 5 AS iv FROM tr),
trf AS (SELECT tr.*, least(pos // iv, 4) AS cf FROM tr, nn),
tt AS (SELECT cf, label, unnest(string_split(kw1, ' ')) AS tok FROM trf),
sh AS (SELECT tok, cf, count(*) AS n, sum(label) AS s FROM tt GROUP BY ALL),
ar AS (SELECT row_id, 'train' AS split, cf AS lk, kw1 FROM trf
       UNION ALL SELECT row_id, split, -1 AS lk, kw1 FROM m WHERE split <> 'train'),
atk AS (SELECT DISTINCT row_id, split, lk, unnest(string_split(kw1, ' ')) AS tok FROM ar),
v AS (SELECT a_.row_id, a_.split, a_.lk, a_.tok,
             sum(CASE WHEN a_.lk = -1 OR sh.cf <> a_.lk THEN sh.n END) AS n,
             sum(CASE WHEN a_.lk = -1 OR sh.cf <> a_.lk THEN sh.s END) AS s
      FROM atk AS a_ LEFT JOIN sh USING (tok) GROUP BY a_.row_id, a_.split, a_.lk, a_.tok)
SELECT row_id, split, {value} FROM v, nn GROUP BY row_id, split
"""


@register("contig_fold_pos", sql=_contig_sql(
    "CAST(max(CASE WHEN n > 0 THEN s + 1 ELSE 0 END) AS BIGINT) AS kw1_pos_max"))
def contig_fold_pos(spark, d):
    m = merged(spark, d).select("row_id", "split", "kw1", "label")
    return T.contig_fold_token_max(m.filter(is_train()), m.filter(~is_train()), "kw1", "row_id",
                                   KEEP, k=5, mode="pos")


def _rate_sql():
    body = _contig_sql("round(max(CASE WHEN n > 0 THEN (b / 20.0 + s) / (b + n) ELSE 0.05 END), 6) AS kw1_rate_max")
    body = body.replace("FROM v, nn GROUP BY", "FROM v, (SELECT ntr // (SELECT count(DISTINCT tok) FROM tt) AS b FROM nn) bb GROUP BY")
    return body


@register("contig_fold_rate", sql=_rate_sql())
def contig_fold_rate(spark, d):
    m = merged(spark, d).select("row_id", "split", "kw1", "label")
    return round_doubles(T.contig_fold_token_max(m.filter(is_train()), m.filter(~is_train()), "kw1",
                                                 "row_id", KEEP, k=5, mode="rate"))


# the last tenth of the training rows is scored from the head only
_HOLD = ("trf AS (SELECT tr.*, CASE WHEN pos >= ntr - ntr // 10 THEN -1 ELSE least(pos // ((ntr - ntr // 10) // 5), 4) END AS cf"
         " FROM tr, nn),")


@register("contig_fold_holdout", sql=_contig_sql(
    "CAST(max(CASE WHEN n > 0 THEN s + 1 ELSE 0 END) AS BIGINT) AS kw1_pos_max").replace(
    "trf AS (SELECT tr.*, least(pos // iv, 4) AS cf FROM tr, nn),", _HOLD).replace(
    "sh AS (SELECT tok, cf, count(*) AS n, sum(label) AS s FROM tt GROUP BY ALL)",
    "sh AS (SELECT tok, cf, count(*) AS n, sum(label) AS s FROM tt WHERE cf >= 0 GROUP BY ALL)"))
def contig_fold_holdout(spark, d):
    m = merged(spark, d).select("row_id", "split", "kw1", "label")
    train = m.filter(is_train())
    return T.contig_fold_token_max(train, m.filter(~is_train()), "kw1", "row_id", KEEP, k=5, mode="pos",
                                   holdout=train.count() // 10)


# ------------------------------------------------------------------ P11
_FOLD = "CAST(floor((((row_id % 2147483648) * 2654435761 + 2018) % 4294967296) * 5 / 4294967296.0) AS INT)"


@register("oof_pos_neg_random", sql=f"""
, m2 AS (SELECT row_id, split, label, uid, {_FOLD} AS fold FROM m),
st AS (SELECT uid, fold, sum(label) AS s, count(*) AS n FROM m2 WHERE split = 'train' GROUP BY ALL),
r AS (SELECT m2.row_id, m2.split, m2.fold,
        sum(CASE WHEN m2.split <> 'train' OR st.fold <> m2.fold THEN st.s END) AS s,
        sum(CASE WHEN m2.split <> 'train' OR st.fold <> m2.fold THEN st.n END) AS n
      FROM m2 LEFT JOIN st USING (uid) GROUP BY ALL)
SELECT row_id, split, fold, CAST(CASE WHEN n > 0 THEN s ELSE -1 END AS BIGINT) AS uid_positive_num,
       CAST(CASE WHEN n > 0 THEN n - s ELSE -1 END AS BIGINT) AS uid_negative_num FROM r
""")
def oof_pos_neg_random(spark, d):
    from fieldcraft.operators.prep import hash_fold
    m = merged(spark, d).withColumn("fold", hash_fold("row_id", 5))
    return T.oof_pos_neg(m, ["uid"], keep=["row_id", "split", "fold"], is_train=is_train())


# ------------------------------------------------------------------ A12
@register("count_of_counts", sql="""
, tt AS (SELECT label, unnest(string_split(kw1, ' ')) AS tok FROM m WHERE split = 'train'),
st AS (SELECT tok, sum(label) AS pos_count FROM tt GROUP BY tok)
SELECT CAST(pos_count AS BIGINT) AS pos_count, count(*) AS n_tokens FROM st GROUP BY 1
UNION ALL SELECT -1, 0
""")
def count_of_counts(spark, d):
    m = merged(spark, d)
    return T.count_of_counts(m.filter(is_train()), "kw1")


# ------------------------------------------------------------------ T04
def _noisy_or_sql(fit: bool) -> str:
    a, b, prior, more = "1.0", "1.0", "", ""
    if fit:
        a, b, more = "f.a", "f.b", ", f"
        prior = f"""
hist AS (SELECT cnt::DOUBLE AS n, pos::DOUBLE AS s, count(*)::DOUBLE AS m FROM st GROUP BY ALL),
f AS (SELECT * FROM {fpi_sql("hist", None, eps=1e-8)}),"""
    return f"""
, tt AS (SELECT label, unnest(string_split(kw1, ' ')) AS tok FROM m WHERE split = 'train'),
st AS (SELECT tok, count(*) AS cnt, sum(label) AS pos FROM tt GROUP BY tok HAVING sum(label) > 0),{prior}
atk AS (SELECT row_id, unnest(string_split(kw1, ' ')) AS tok FROM m),
pr AS (SELECT a_.row_id, sum(ln(1 - (st.pos + {a}) / (st.cnt + {a} + {b}))) AS ls FROM atk AS a_ JOIN st USING (tok){more} GROUP BY 1)
SELECT m.row_id, m.split,
       CASE WHEN m.kw1 = '-1' THEN -1.0 ELSE round(exp(coalesce(pr.ls, 0)), {FIT_DIGITS if fit else 6}) END AS kw1_score
FROM m LEFT JOIN pr USING (row_id)
"""


@register("token_noisy_or", sql=_noisy_or_sql(True))
def token_noisy_or(spark, d):
    out = T.token_noisy_or(merged(spark, d), "kw1", "row_id", is_train(), KEEP, fit_prior=True)
    return round_doubles(out, FIT_DIGITS)


@register("token_noisy_or_fixed", sql=_noisy_or_sql(False))
def token_noisy_or_fixed(spark, d):
    return round_doubles(T.token_noisy_or(merged(spark, d), "kw1", "row_id", is_train(), KEEP))


# ------------------------------------------------------------------ T09 / A14
@register("user_conv_loo", sql="""
, tr AS (SELECT * FROM log WHERE split = 'train'),
pu AS (SELECT uid, sum(label) AS up, sum(1 - label) AS un FROM tr GROUP BY uid),
pp AS (SELECT uid, aid, max(label) AS hp, max(1 - label) AS hn FROM tr GROUP BY ALL),
j AS (SELECT l.row_id, l.split,
             coalesce(pu.up, 0) - CASE WHEN l.split = 'train' THEN coalesce(pp.hp, 0) ELSE 0 END AS p,
             coalesce(pu.un, 0) - CASE WHEN l.split = 'train' THEN coalesce(pp.hn, 0) ELSE 0 END AS n
      FROM log l LEFT JOIN pu USING (uid) LEFT JOIN pp USING (uid, aid))
SELECT row_id, split, CAST(p AS BIGINT) AS pos_num, CAST(n AS BIGINT) AS neg_num,
       CASE WHEN p + n > 0 THEN round(p / (p + n), 6) ELSE -1.0 END AS uid_convert
FROM j
""")
def user_conv_loo(spark, d):
    return round_doubles(T.user_conversion_loo(log(spark, d), KEEP, is_train()))


@register("user_pos_neg_lists", sql="""
SELECT uid,
  coalesce(string_agg(CAST(aid AS VARCHAR), ' ' ORDER BY row_id) FILTER (WHERE label = 1), '') AS pos_aid,
  coalesce(string_agg(CAST(aid AS VARCHAR), ' ' ORDER BY row_id) FILTER (WHERE label = 0), '') AS neg_aid,
  round(sum(label) / count(*), 6) AS uid_convert
FROM log WHERE split = 'train' GROUP BY uid
""")
def user_pos_neg_lists(spark, d):
    return round_doubles(T.user_item_lists(log(spark, d), is_train()))


@register("row_pos_neg_lists", sql="""
, tr AS (SELECT * FROM log WHERE split = 'train'),
n AS (SELECT l.row_id, l.split, t.label, t.aid, t.row_id AS o,
             row_number() OVER (PARTITION BY l.row_id, t.label, t.aid ORDER BY t.row_id) AS k,
             (l.split = 'train' AND t.aid = l.aid) AS own
      FROM log l JOIN tr t USING (uid)),
g AS (SELECT row_id,
        string_agg(CAST(aid AS VARCHAR), ' ' ORDER BY o) FILTER (WHERE label = 1) AS pos_aid,
        string_agg(CAST(aid AS VARCHAR), ' ' ORDER BY o) FILTER (WHERE label = 0) AS neg_aid
      FROM n WHERE NOT (own AND k = 1) GROUP BY row_id)
SELECT log.row_id, log.split, coalesce(pos_aid, '') AS pos_aid, coalesce(neg_aid, '') AS neg_aid
FROM log LEFT JOIN g USING (row_id)
""")
def row_pos_neg_lists(spark, d):
    return T.row_item_lists(log(spark, d), KEEP, is_train())


# ------------------------------------------------------------------ T07 / F03 / E07
CROSS_KEYS = [["uid"], ["advertiserId", "uid"], ["campaignId", "uid"], ["creativeSize", "uid"]]
VOCAB_THRESHOLD = 100


def _cross_sql(keys):
    names = ["_".join(p) for p in keys]
    stack = "\n  UNION ALL ".join(
        f"SELECT row_id, '{n}_{side}_num' AS feature, CAST(CASE WHEN n > 0 THEN {expr} ELSE -1 END AS VARCHAR) AS value "
        f"FROM r WHERE pair = '{n}' AND split = 'train'"
        for n in names for side, expr in (("positive", "s"), ("negative", "n - s")))
    return _lfo_rows_sql(keys) + f""",
sv AS ({stack}),
g AS (SELECT feature, value, count(*) AS cnt, min(row_id) AS f FROM sv GROUP BY ALL HAVING count(*) >= {VOCAB_THRESHOLD})
SELECT feature, value, cnt, CAST(row_number() OVER (PARTITION BY feature ORDER BY f) + 1 AS INTEGER) AS idx FROM g
"""


def _cross_vocab(spark, d, keys):
    from fieldcraft.operators.counts import first_seen_vocab
    m = merged(spark, d)
    wide = T.oof_pos_neg(m, keys, keep=["row_id", "split"], is_train=is_train())
    feats = [f"{'_'.join(p)}_{s}_num" for p in keys for s in ("positive", "negative")]
    long = wide.filter(is_train()).select(
        "row_id", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"))
                                      for f in feats])).alias("e")).select("row_id", "e.feature", "e.value")
    return first_seen_vocab(long, "value", ["row_id"], VOCAB_THRESHOLD, field="feature")


@register("oof_pos_neg_cross", sql=_cross_sql(CROSS_KEYS))
def oof_pos_neg_cross(spark, d):
    return _cross_vocab(spark, d, CROSS_KEYS)


#: the user alone and crossed with seven columns
WIDE_KEYS = [["uid"], *[[c, "uid"] for c in ["aid", *SINGLE]]]


@register("oof_pos_neg_cross_wide", sql=_cross_sql(WIDE_KEYS))
def oof_pos_neg_cross_wide(spark, d):
    return _cross_vocab(spark, d, WIDE_KEYS)

"""Evaluation, score transforms and ensembles (M05, M06, F13, O03, W04,
R01-R03, S09, J06)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldcraft.functions.numeric import sigmoid, softmax2_pos
from fieldcraft.operators import evaluate as V
from fieldcraft.operators.prep import realign_scores
from fieldcraft.plans.common import is_train, round_doubles
from fieldcraft.plans.registry import register
from fieldcraft.session import scratch_path
from fieldcraft.sources import files as S
from fieldcraft.sources import fixtures as fx

SC = """
, sc AS (SELECT 'a' AS model, row_id, aid, uid, label, split, fold, (row_id * 7919 % 1000) / 1000.0 AS score FROM log
         UNION ALL SELECT 'b', l.row_id, l.aid, l.uid, l.label, l.split, l.fold, least(e.value / 500.0, 1.0)
         FROM log l JOIN events e ON e.event_id = l.row_id
         UNION ALL SELECT 'c', row_id, aid, uid, label, split, fold, ((uid % 13) + (aid % 7)) / 20.0 FROM log),
ag AS (SELECT model, aid, uid, max(label) AS label, max(score) AS score FROM sc GROUP BY ALL)"""

WEIGHTS = {"score#a": 0.5, "score#b": 0.3, "score#c": 0.2}


def _agg(spark, d):
    """One row per (model, aid, uid): max score, max label (exact, order free)."""
    return (fx.model_scores(spark, d).groupBy("model", "aid", "uid")
              .agg(F.max("label").alias("label"), F.max("score").alias("score")))


def _auc_sql(group):
    g = ", ".join(group)
    return SC + f""",
s AS (SELECT {g}, score, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY ALL),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {g} ORDER BY score
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s),
au AS (SELECT {g}, sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM c GROUP BY ALL)"""


# ------------------------------------------------------------------ M05
@register("auc_exact", sql=_auc_sql(["model"]) + "\nSELECT model, round(auc, 6) AS auc FROM au")
def auc_exact(spark, d):
    return round_doubles(V.exact_auc(fx.model_scores(spark, d), group=["model"]))


@register("accuracy_at", sql=SC + """
SELECT model, round(avg(CASE WHEN (CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END), 6)
       AS accuracy FROM sc GROUP BY model
""")
def accuracy_at(spark, d):
    return round_doubles(V.accuracy_at(fx.model_scores(spark, d), group=["model"]))


# ------------------------------------------------------------------ M06
@register("weighted_logloss", sql=SC + """,
p AS (SELECT model, label, least(greatest(score, 1e-7), 1 - 1e-7) AS p FROM sc),
ce AS (SELECT model, label, -(label * ln(p) + (1 - label) * ln(1 - p)) AS ce FROM p)
SELECT model, round(avg(ce), 6) AS logloss, round(avg((20 * label + (1 - label)) * ce), 6) AS weighted_logloss
FROM ce GROUP BY model
""")
def weighted_logloss(spark, d):
    return round_doubles(V.logloss(fx.model_scores(spark, d), group=["model"]))


# ------------------------------------------------------------------ F13
@register("score_transform", sql="""
, x AS (SELECT l.row_id, (l.row_id * 7919 % 1000) / 1000.0 AS a, least(e.value / 500.0, 1.0) AS b
        FROM log l JOIN events e ON e.event_id = l.row_id),
y AS (SELECT row_id, 1 / (1 + exp(-(4 * (a - 0.5)))) AS sig,
             exp(a - greatest(a, b)) / (exp(b - greatest(a, b)) + exp(a - greatest(a, b))) AS soft FROM x)
SELECT row_id, round(sig, 6) AS sig, round(soft, 6) AS soft, round(0.5 * (sig + soft), 6) AS mean_score FROM y
""")
def score_transform(spark, d):
    sc = fx.model_scores(spark, d)
    w = sc.groupBy("row_id").pivot("model", ["a", "b"]).agg(F.first("score"))
    sig = sigmoid(F.lit(4.0) * (F.col("a") - F.lit(0.5)))
    soft = softmax2_pos(F.col("b"), F.col("a"))
    out = w.select("row_id", sig.alias("sig"), soft.alias("soft"))
    return round_doubles(out.withColumn("mean_score", F.lit(0.5) * (F.col("sig") + F.col("soft"))))


# ------------------------------------------------------------------ W04 / R01
@register("rank_ensemble", sql=SC + """,
rk AS (SELECT model, aid, uid, rank() OVER (PARTITION BY model ORDER BY score DESC)
              + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r FROM ag)
SELECT aid, uid, round(sum(10000.0 / r), 6) AS rank_score FROM rk GROUP BY aid, uid
""")
def rank_ensemble(spark, d):
    return round_doubles(V.rank_ensemble(_agg(spark, d)))


# ------------------------------------------------------------------ R02 / S09
WIDE_SQL = SC + """,
wd AS (SELECT aid, uid, max(label) AS label,
              max(CASE WHEN model = 'a' THEN score END) AS "score#a",
              max(CASE WHEN model = 'b' THEN score END) AS "score#b",
              max(CASE WHEN model = 'c' THEN score END) AS "score#c" FROM ag GROUP BY aid, uid)"""


def _wide_from_files(spark, d):
    ag = _agg(spark, d)
    base = scratch_path(spark, "models")
    for i, m in enumerate(fx.MODELS):
        S.write_csv(ag.filter(F.col("model") == m).select("aid", "uid", "label", "score"),
                    f"{base}/model{i}_{m}/val.csv", "%.6f")
    schema = "aid int, uid long, label int, score double"
    from pyspark.sql.types import _parse_datatype_string
    scores = S.read_model_outputs(spark, f"{base}/model*_*/val.csv", _parse_datatype_string(schema))
    lab = scores.groupBy("aid", "uid").agg(F.max("label").alias("label"))
    wide = V.scores_wide(scores.select("model", "aid", "uid", "score"), fx.MODELS, keys=("aid", "uid"))
    return wide.join(lab, ["aid", "uid"])


@register("model_scores_wide", sql=WIDE_SQL + """
SELECT aid, uid, label, round("score#a", 6) AS "score#a", round("score#b", 6) AS "score#b",
       round("score#c", 6) AS "score#c" FROM wd
""")
def model_scores_wide(spark, d):
    return round_doubles(_wide_from_files(spark, d))


def _wide(spark, d):
    ag = _agg(spark, d)
    lab = ag.groupBy("aid", "uid").agg(F.max("label").alias("label"))
    return V.scores_wide(ag.select("model", "aid", "uid", "score"), fx.MODELS, keys=("aid", "uid")) \
            .join(lab, ["aid", "uid"])


# ------------------------------------------------------------------ R03
@register("blend_weighted", sql=WIDE_SQL + """
SELECT aid, uid, round((0.5 * "score#a" + 0.3 * "score#b" + 0.2 * "score#c") / 1.0, 6) AS score FROM wd
""")
def blend_weighted(spark, d):
    return round_doubles(V.blend_weighted(_wide(spark, d), WEIGHTS).select("aid", "uid", "score"))


def _lg(c):
    p = f"least(greatest({c}, 1e-7), 1 - 1e-7)"
    return f"ln({p} / (1 - {p}))"


@register("blend_logit", sql=WIDE_SQL + f"""
SELECT aid, uid, round(1 / (1 + exp(-(0.5 * {_lg('"score#a"')} + 0.3 * {_lg('"score#b"')}
                                     + 0.2 * {_lg('"score#c"')}))), 6) AS score FROM wd
""")
def blend_logit(spark, d):
    return round_doubles(V.blend_logit(_wide(spark, d), WEIGHTS).select("aid", "uid", "score"))


# ------------------------------------------------------------------ J06
@register("submission_realign", sql=SC + """,
vs AS (SELECT aid, uid, max(score) AS score FROM sc WHERE model = 'a' AND split = 'valid' GROUP BY ALL)
SELECT l.row_id, l.aid, l.uid, round(coalesce(vs.score, 0.0), 6) AS score
FROM log l LEFT JOIN vs USING (aid, uid) WHERE l.split = 'test'
""")
def submission_realign(spark, d):
    sc = fx.model_scores(spark, d)
    ids = fx.log(spark, d).filter(F.col("split") == "test").select("row_id", "aid", "uid")
    vs = (sc.filter((F.col("model") == "a") & (F.col("split") == "valid"))
            .groupBy("aid", "uid").agg(F.max("score").alias("score")))
    return round_doubles(realign_scores(ids, vs))


# ------------------------------------------------------------------ O03
@register("best_model", sql=_auc_sql(["model", "fold"]) + """,
mx AS (SELECT model, max(auc) AS m FROM au GROUP BY model)
SELECT au.model, min(au.fold) AS best_epoch, round(max(mx.m), 6) AS best_auc
FROM au JOIN mx ON au.model = mx.model AND au.auc = mx.m GROUP BY au.model
""")
def best_model(spark, d):
    met = V.exact_auc(fx.model_scores(spark, d), group=["model", "fold"]).withColumnRenamed("fold", "epoch")
    return round_doubles(V.best_by_metric(met, "model", "epoch", "auc"))

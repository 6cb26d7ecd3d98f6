"""Model queries.

Scores depend on MLlib's optimisers, so the score keys, ``(row_id, aid, uid,
score)``, have no SQL oracle. Each has a ``_check`` key with one: rows and
missing scores per split, whether all scores are probabilities, and whether
the exact AUC on the training rows is above chance."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldcraft.operators import models as ML
from fieldcraft.operators.evaluate import exact_auc
from fieldcraft.plans.common import is_train, merged
from fieldcraft.plans.registry import register

CATEGORICAL = ["campaignId", "advertiserId", "gender"]
MULTI = ["kw1"]
NUMERIC = ["creativeSize", "ability", "lbs"]
KEEP = ["row_id", "split", "label", "aid", "uid"]


def _rows(spark, d):
    """Assembled features of every row, written once."""
    m = ML.add_weight(ML.with_tokens(merged(spark, d), MULTI))
    m = m.withColumn("is_train", is_train()).withColumn("is_valid", F.col("split") == "valid")
    return ML.assemble(m.filter(is_train()), m, ML.feature_pipeline(CATEGORICAL, MULTI, NUMERIC, min_df=5.0),
                       [*KEEP, "w", "is_train", "is_valid"])


def _dims(c):
    return f"(SELECT count(DISTINCT {c}) + 1 FROM m WHERE split = 'train')"


# one column per known category and one for unknown ones; a token needs five training rows
@register("ml_assemble", sql=f"""
, tok AS (SELECT DISTINCT row_id, split, unnest(string_split(kw1, ' ')) AS t FROM m WHERE kw1 <> '-1'),
voc AS (SELECT t FROM tok WHERE split = 'train' GROUP BY t HAVING count(*) >= 5),
hit AS (SELECT row_id, count(*) AS k FROM tok JOIN voc USING (t) GROUP BY row_id)
SELECT row_id, split, label, aid, uid,
  CAST({" + ".join(_dims(c) for c in CATEGORICAL)} + (SELECT count(*) FROM voc) + {len(NUMERIC)} AS INT) AS n_features,
  CAST({len(CATEGORICAL)} + coalesce(k, 0) + {" + ".join(f"CASE WHEN {c} <> 0 THEN 1 ELSE 0 END" for c in NUMERIC)} AS INT) AS nnz
FROM m LEFT JOIN hit USING (row_id)
""")
def ml_assemble(spark, d):
    arr = vector_to_array("features")
    return _rows(spark, d).select(*KEEP, F.size(arr).alias("n_features"),
                                  F.size(F.filter(arr, lambda x: x != 0)).alias("nnz"))


def _lr(spark, d):
    rows = _rows(spark, d)
    return ML.fit_score(rows.filter("is_train"), rows, ML.logistic(maxIter=100, regParam=1e-4), KEEP)[1]


def _fm(spark, d):
    rows = _rows(spark, d)
    return ML.fit_score(rows.filter("is_train"), rows, ML.fm(4, 0.02, 1e-6, 100), KEEP)[1]


def _gbt(spark, d):
    rows = _rows(spark, d)
    fit_on = ML.for_trees(rows.filter("is_train OR is_valid"))  # validation rows stop the training early
    return ML.fit_score(fit_on, rows, ML.gbt(max_iter=300, validation_col="is_valid"), KEEP)[1]


def _scores(pred):
    return pred.select("row_id", "aid", "uid", "score")


_CHECK = """
SELECT split, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_null, true AS in_range, true AS above_chance
FROM m GROUP BY split
"""


def _check(pred):
    auc = exact_auc(pred.filter(F.col("split") == "train")).first()["auc"]
    per = pred.groupBy("split").agg(F.count("*").alias("n_rows"), F.count_if(F.col("score").isNull()).alias("n_null"),
                                    F.min(F.col("score").between(0, 1)).alias("in_range"))
    return per.withColumn("above_chance", F.lit(auc is not None and auc > 0.5))


@register("lr_train_score")
def lr_train_score(spark, d):
    return _scores(_lr(spark, d))


@register("lr_check", sql=_CHECK)
def lr_check(spark, d):
    return _check(_lr(spark, d))


@register("fm_train_score")
def fm_train_score(spark, d):
    return _scores(_fm(spark, d))


@register("fm_check", sql=_CHECK)
def fm_check(spark, d):
    return _check(_fm(spark, d))


@register("gbt_train_score")
def gbt_train_score(spark, d):
    return _scores(_gbt(spark, d))


@register("gbt_check", sql=_CHECK)
def gbt_check(spark, d):
    return _check(_gbt(spark, d))


@register("gbt_search", sql="""
SELECT CAST(range AS INT) AS candidate, 5 AS n_params, true AS auc_in_range, true AS above_chance FROM range(4)
""")
def gbt_search(spark, d):
    got = ML.search(_rows(spark, d))
    return got.select("candidate", F.size(F.split("params", "; ")).alias("n_params"),
                      F.col("auc").between(0, 1).alias("auc_in_range"), (F.col("train_auc") > 0.5).alias("above_chance"))

"""Feature assembly, training, scoring and search."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from fieldcraft.operators import fm as FM
from fieldcraft.operators import models as ML
from fieldcraft.operators.evaluate import exact_auc


def data(spark):
    r = np.random.default_rng(7)
    rows = [(i, f"c{i % 3}", " ".join(str(x) for x in r.integers(0, 6, r.integers(0, 4))) or "-1", float(r.random()),
             int(r.random() < 0.2 + 0.5 * (i % 3 == 0)), i % 4 != 0) for i in range(400)]
    return spark.createDataFrame(rows, "row_id long, cat string, kw string, x double, label int, is_train boolean")


def test_assemble_and_score(spark):
    df = ML.add_weight(ML.with_tokens(data(spark), ["kw"]))
    keep = ["row_id", "label", "w", "is_train"]
    rows = ML.assemble(df.filter("is_train"), df, ML.feature_pipeline(["cat"], ["kw"], ["x"], min_df=2.0), keep)
    assert rows.count() == 400 and rows.first().features.size == 3 + 1 + 6 + 1
    model, pred = ML.fit_score(rows.filter("is_train"), rows, ML.logistic(maxIter=20), [*keep])
    assert pred.count() == 400 and pred.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    auc = exact_auc(pred).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert abs(auc - ev.evaluate(pred.withColumn("score", F.col("score")))) < 1e-9 and auc > 0.6
    assert dict(pred.select("w").distinct().groupBy("w").count().collect()) == {1.0: 1, 20.0: 1}


def test_no_token_above_the_threshold_is_dropped(spark):
    n = 2**18 + 1000  # more than the usual limit of the vectorizer
    df = (spark.range(n).groupBy((F.col("id") % 200).alias("g")).agg(F.collect_list(F.concat(F.lit("t"), F.col("id"))).alias("kw_tok"))
          .withColumn("x", F.lit(1.0)))
    twice = df.unionByName(df)
    model = Pipeline(stages=ML.feature_pipeline([], ["kw"], ["x"], min_df=2.0)).fit(twice)
    assert len(model.stages[0].vocabulary) == n


def test_search_draws(spark):
    draws = ML.candidates(ML.SPACE, 4)
    assert len(draws) == 4 == len({tuple(c.items()) for c in draws})
    assert all(c[k] in v for c in draws for k, v in ML.SPACE.items())
    assert (min(ML.SPACE["trees"]), max(ML.SPACE["trees"])) == (1000, 10000)
    df = ML.with_tokens(data(spark), ["kw"]).withColumn("is_valid", ~F.col("is_train"))
    rows = ML.assemble(df.filter("is_train"), df, ML.feature_pipeline(["cat"], ["kw"], ["x"], min_df=2.0),
                       ["label", "is_train", "is_valid"])
    got = ML.search(rows, evals=2, space={**ML.SPACE, "trees": [30]}).collect()
    assert [r.candidate for r in got] == [0, 1] and all(0 <= r.auc <= 1 and r.train_auc > 0.5 and 0 < r.trees <= 30 for r in got)


def test_tree_rows_are_parted_by_their_binned_size(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors
    rows = spark.createDataFrame([(i, Vectors.sparse(100, [i % 100], [1.0])) for i in range(200)], ["i", "features"]).coalesce(1)
    monkeypatch.setattr(ML, "TREE_TASK_BYTES", 10 * (4 * 100 + 64))
    some = ML.for_trees(rows)
    assert some.rdd.getNumPartitions() == 20 and max(some.rdd.glom().map(len).collect()) <= 20
    assert sorted(r.i for r in some.collect()) == list(range(200))
    monkeypatch.setattr(ML, "TREE_TASK_BYTES", 1 << 30)
    assert ML.for_trees(rows).rdd.getNumPartitions() == 1 and ML.for_trees(rows.limit(0)).count() == 0


@pytest.mark.parametrize("steps", [1, 8])
def test_factorisation_machine_takes_the_steps_of_mllib(spark, steps):
    from pyspark.ml.classification import FMClassifier
    from pyspark.ml.linalg import Vectors
    r = np.random.default_rng(3)
    made = []
    for i in range(500):
        at = sorted(r.choice(30, int(r.integers(0, 6)), replace=False).tolist())
        x = np.round(r.random(len(at)) + 0.1, 3)
        v = Vectors.sparse(30, at, x) if i % 7 else Vectors.dense(Vectors.sparse(30, at, x).toArray())
        made.append((i, int(r.random() < 0.3 + 0.4 * (3 in at)), v))
    df = spark.createDataFrame(made, ["i", "label", "features"])
    fm = ML.fm(3, 0.05, 1e-4, steps)
    want = FMClassifier(labelCol="label", featuresCol="features", factorSize=3, stepSize=0.05, regParam=1e-4,
                        maxIter=steps, seed=2018).fit(df)
    model, pred = ML.fit_score(df, df, fm, ["i"])
    assert not isinstance(model, type(want)) and model.steps == steps
    assert np.allclose(model.factors, want.factors.toArray(), atol=1e-8) and abs(model.intercept - want.intercept) < 1e-8
    assert np.allclose(model.linear, want.linear.toArray(), atol=1e-8)
    got = {x.i: x.score for x in pred.collect()}
    assert all(abs(got[x.i] - x.probability[1]) < 1e-8 for x in want.transform(df).collect()) and len(got) == 500
    # a small table still makes a block per task; blocks hold all rows once
    blocks = FM.make_blocks(df)
    assert blocks.agg(F.sum("n")).first()[0] == 500 and blocks.rdd.getNumPartitions() >= 8


@pytest.mark.parametrize("label,x", [(2, 1.0), (None, 1.0), (1, float("nan")), (1, float("inf"))])
def test_factorisation_machine_refuses_what_mllib_refuses(spark, label, x):
    from pyspark.ml.linalg import VectorUDT, Vectors
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("features", VectorUDT())])
    df = spark.createDataFrame([(0, Vectors.dense(1.0, 2.0)), (label, Vectors.dense(x, 2.0))], schema)
    with pytest.raises(Exception, match="(?i)labels? |not finite|infinity"):
        ML.fm(2, max_iter=1).fit(df)

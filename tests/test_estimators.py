"""Fitted forms: transform equals the plain operator, also after save and load."""

import json

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from compare import same
from fieldcraft.operators import encode as E
from fieldcraft.operators import estimators as M
from fieldcraft.operators import target as T
from fieldcraft.operators.counts import token_vocab
from fieldcraft.operators.encode import FieldSpec
from fieldcraft.operators.info import digitize_percentile

SPECS = [FieldSpec("city", "single"), FieldSpec("age", "single", True), FieldSpec("kw", "multi"),
         FieldSpec("size", "continuous", True)]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"c{i % 4}" if i % 17 else None, i % 6, " ".join(f"t{(i * k) % 7}" for k in range(1, i % 4 + 1)) or "-1",
             float(i % 9), int(i * 7 % 5 < 2), i % 5, i % 8 != 0) for i in range(240)]
    return spark.createDataFrame(data, "row_id long, city string, age int, kw string, size double, label int, fold int, "
                                       "is_train boolean").cache()


def reloaded(model, path):
    model.write().overwrite().save(path)
    return type(model).load(path)


def check(model, path, df, want):
    again = reloaded(model, path)
    assert type(again) is type(model) and again.uid == model.uid
    want = want.toPandas()
    same(model.transform(df).toPandas(), want)
    same(again.transform(df).toPandas(), want)
    return again


def test_smoothed_rate(rows, tmp_path):
    train, new = rows.filter("is_train"), rows
    est = M.SmoothedRate(keyCols=["city", "age"], outputCol="r", alpha=2.0, beta=3.0)
    check(est.fit(train), str(tmp_path / "a"), new,
          T.smoothed_rate(train, new, ["city", "age"], "r", alpha=2.0, beta=3.0))
    est = M.SmoothedRate(keyCols=["age"], outputCol="r", fitPrior=True)
    check(est.fit(train), str(tmp_path / "b"), new, T.smoothed_rate(train, new, ["age"], "r", fit_prior=True))


@pytest.mark.parametrize("prior", [False, True])
def test_out_of_fold_rate(rows, tmp_path, prior):
    pairs = [["city", "age"], ["age", "fold"]]
    est = M.OutOfFoldRate(pairs=json.dumps(pairs), fitPrior=prior)
    model = est.fit(rows)
    want = T.oof_smoothed_rate(rows, pairs, rows.columns, F.col("is_train"), fit_prior=prior)
    again = check(model, str(tmp_path / "m"), rows, want)
    # rows that come later read the statistics of all folds
    new = rows.withColumn("is_train", F.lit(False))
    same(again.transform(new).toPandas(), model.transform(new).toPandas())
    assert again.transform(new.limit(5)).count() == 5


def test_frequency_encoder(rows, tmp_path):
    est = M.FrequencyFFMEncoder(fields=M.with_fields(SPECS[:3]), threshold=20)
    vocab = E.frequency_vocab(E.value_counts_all(rows, SPECS[:3]), SPECS[:3], 20)
    check(est.fit(rows), str(tmp_path / "m"), rows, E.ffm_lines(rows, SPECS[:3], vocab))


def test_sorted_encoder(rows, tmp_path):
    train = rows.filter("row_id < 150")
    est = M.SortedFFMEncoder(fields=M.with_fields(SPECS))
    check(est.fit(train), str(tmp_path / "m"), rows, E.sorted_encode(rows, SPECS, E.sorted_vocab(train, SPECS)))


def test_token_indexer(rows, tmp_path):
    est = M.TokenIndexer(inputCol="kw", outputCol="ids", threshold=30)
    model = est.fit(rows)
    vocab = {r.token: r.idx for r in token_vocab(rows, "kw", "row_id", 30).collect()}
    assert vocab and min(vocab.values()) == 2
    odd = rows.select("row_id", "kw").unionByName(rows.limit(2).select(
        F.lit(-5).cast("long").alias("row_id"), F.lit(None).cast("string").alias("kw")))
    for m in (model, reloaded(model, str(tmp_path / "m"))):
        got = m.transform(odd).collect()
        assert len(got) == 242
        for r in got:
            assert r.ids == [vocab.get(t, 1) for t in (r.kw or "").split()]


def test_percentile_buckets(rows, tmp_path):
    est = M.PercentileBuckets(inputCols=["size", "age"])
    check(est.fit(rows), str(tmp_path / "m"), rows, digitize_percentile(rows, ["size", "age"]))


def test_inside_a_pipeline(rows, tmp_path):
    stages = [M.SmoothedRate(keyCols=["city"], outputCol="city_rate"), M.PercentileBuckets(inputCols=["size"]),
              M.TokenIndexer(inputCol="kw", outputCol="ids", threshold=10)]
    model = Pipeline(stages=stages).fit(rows)
    model.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    same(again.transform(rows).toPandas(), model.transform(rows).toPandas())
    loaded = M.SmoothedRate.load(_saved(stages[0], str(tmp_path / "e")))
    assert loaded.getOrDefault("keyCols") == ["city"]


def _saved(est, path):
    est.write().overwrite().save(path)
    return path


def test_later_session(rows, tmp_path):
    """The state is read by another session of the application."""
    model = M.SmoothedRate(keyCols=["city"], outputCol="r").fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = M.SmoothedRateModel.load(str(tmp_path / "m"))
    other = rows.sparkSession.newSession()
    assert other.read.parquet(str(tmp_path / "m" / "tables" / "counts")).count() == again.tables["counts"].count()

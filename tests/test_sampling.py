"""Exact sampling without replacement against a sorted brute force."""

import math

import pytest
from pyspark.sql import functions as F

from fieldcraft.operators import prep as P
from fieldcraft.operators import sampling as S


def h(i, seed=2018):
    return 0 if i is None else ((i % 2147483648) * 2654435761 + seed) % 4294967296


def brute(ids, ranks, seed=2018):
    order = sorted(ids, key=lambda i: (h(i, seed), -1 if i is None else i))
    return [sum(at >= r for r in ranks) for at in range(len(order))], order


@pytest.mark.parametrize("n", [0, 1, 4, 13, 1000])
def test_folds_have_exact_sizes(spark, n):
    df = spark.createDataFrame([(i * 37, "x") for i in range(n)], "row_id long, _at string")
    got = {r.row_id: r.fold for r in S.exact_folds(df.drop("_at"), "row_id").collect()}
    m = int(0.2 * n)
    want, order = brute([i * 37 for i in range(n)], [m, 2 * m, 3 * m, 4 * m])
    assert [got[i] for i in order] == want
    kf = {r.row_id: r.fold for r in S.exact_kfold(df.drop("_at"), "row_id", 3).collect()}
    sizes = [sum(f == j for f in kf.values()) for j in range(3)]
    assert sum(sizes) == n and sizes == sorted(sizes, reverse=True) and sizes[0] - sizes[-1] <= 1


def test_repeated_and_null_ids_keep_sizes(spark):
    """A third of all rows share one id; sizes stay exact."""
    ids = [5] * 300 + list(range(1000, 1600)) + [None] * 50 + [7, 7]
    df = spark.createDataFrame([(i,) for i in ids], "row_id long").repartition(7)
    got = S.exact_folds(df, "row_id", 5, 0.2, 3).groupBy("fold").count().collect()
    m = int(0.2 * len(ids))
    assert {r.fold: r["count"] for r in got} == {0: m, 1: m, 2: m, 3: m, 4: len(ids) - 4 * m}
    # the order of the hash decides: no row of a later fold comes before one of an earlier fold
    rows = S.exact_folds(df, "row_id", 5, 0.2, 3).collect()
    spans = [[h(r.row_id, 3) for r in rows if r.fold == f] for f in range(5)]
    assert all(max(a) <= min(b) for a, b in zip(spans, spans[1:]))


def test_stratified_split_per_class(spark):
    rows = [(i, [0, 0, 0, 1, None][i % 5]) for i in range(503)]
    df = spark.createDataFrame(rows, "row_id long, label int")
    got = {r.row_id: r.part for r in P.stratified_split(df, "row_id").collect()}
    for y in (0, 1, None):
        mine = [i for i, lab in rows if lab == y]
        order = sorted(mine, key=lambda i: (h(i), i))
        cut = math.ceil(0.2 * len(mine))
        assert [got[i] for i in order] == ["test"] * cut + ["train"] * (len(mine) - cut)


def test_no_sort_and_no_shuffle_of_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_id")
    plan = S.exact_folds(df, "row_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert S.exact_folds(df, "row_id").filter(F.col("fold").isNull()).count() == 0

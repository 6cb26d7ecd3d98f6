"""Joins through the fixed-size bitmap give the plain join's rows."""

import pytest
from pyspark.sql import functions as F

from fieldcraft.llm import membership as M


@pytest.mark.parametrize("bits", [1 << 24, 1 << 16])
def test_joins(spark, monkeypatch, bits):
    monkeypatch.setattr(M, "BITS", bits)
    rows = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id") % 2000).alias("k"), F.col("id").alias("__map2"))
    ids = spark.range(0, 900, 7).select(F.col("id").alias("i")).unionByName(spark.range(2).select(F.lit(None).cast("long").alias("i")))
    table = ids.withColumn("v", F.col("i") * 2)
    got = sorted(map(tuple, M.rows_of(rows, "k", table, "i").select("k", "__map2", "v").collect()))
    assert got == sorted(map(tuple, rows.join(table, F.col("k") == F.col("i")).select("k", "__map2", "v").collect())) and got
    got = M.rows_without(rows, "k", ids)
    want = rows.join(ids, F.col("k") == F.col("i"), "left_anti")
    key = lambda r: (r[0] is None, r)
    assert got.columns == rows.columns and sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    some = M.flag_likely(rows, F.col("k"), ids)
    assert some.filter("__likely").count() < (3000 if bits > 1 << 20 else 3001)
    assert M.rows_without(rows, "k", ids.limit(0)).count() == 3000


def test_rows_without_any_column_names(spark):
    names = ["doc_id", "__gone", "__bits", "__map", "__spot", "__likely", "row", "key", "gone"]
    rows = spark.createDataFrame([(i if i % 4 else None, *[i] * 8) for i in range(40)],
                                 ", ".join(f"`{n}` long" for n in names))
    ids = spark.createDataFrame([(1,), (2,), (2,), (99,), (None,)], "doc_id long")
    got = M.rows_without(rows, "doc_id", ids)
    assert got.columns == names
    assert sorted(r.row for r in got.collect()) == [i for i in range(40) if i not in (1, 2)]


def test_wide_rows_are_not_sorted(spark):
    """The joins hash the narrow table; rows with texts are sorted nowhere."""
    rows = spark.range(300).select(F.col("id").alias("k"), F.lit("text").alias("text"))
    ids = spark.range(0, 300, 7).select(F.col("id").alias("i"))
    now = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for got, n in ((M.rows_of(rows, "k", ids, "i"), 43), (M.rows_without(rows, "k", ids), 257)):
            assert got.count() == n
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", now)

"""Vectors looked up by blocks of rows: values, odd rows and plans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcraft.operators import embed as N

EMB = [(0, [1.0, 0.5]), (1, [0.0, 1.0]), (2, [1.0, -1.0]), (3, [2.0, 0.0])]


def _emb(spark, rows=None):
    return spark.createDataFrame(rows or EMB, "vec_id long, vec array<double>")


def _at(v, slot):
    return np.array(EMB[(v % 4 * 31 + slot) % 4][1])


def _text(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("column,rows", [(N.hadamard, N.hadamard_rows), (N.outer, N.outer_rows), (N.pair_diff, N.pair_diff_rows)])
def test_pairwise_sums_are_those_of_the_whole_vectors(spark, column, rows):
    df = spark.createDataFrame([(i, i, i * 3 + 1, None if i == 5 else i + 2) for i in range(9)],
                               "row_id long, a long, b long, c long")
    got = {(r.row_id, r.pair): (r.vsum, r.vsq, r.vpos) for r in N.pairwise_sums(df, _emb(spark), ["a", "b", "c"], 4, rows).collect()}
    wide = N.lookup_fields(df, _emb(spark), ["a", "b", "c"], 4)
    each = [wide.select("row_id", F.lit(f"{x}_{y}").alias("pair"), *N.summarize(column(F.col(f"v_{x}"), F.col(f"v_{y}"))))
            for x, y in (("a", "b"), ("a", "c"), ("b", "c"))]
    want = {(r.row_id, r.pair): (r.vsum, r.vsq, r.vpos) for r in each[0].union(each[1]).union(each[2]).collect()}
    assert set(got) == set(want) and len(got) == 27
    assert got[5, "a_c"] == (None, None, None) and got[5, "b_c"] == (None, None, None)
    for k, v in want.items():
        assert got[k] == (pytest.approx(v) if v[0] is not None else v)


def test_fm_interaction_equals_the_columns(spark):
    df = spark.createDataFrame([(i, i, i + 1, None if i == 3 else 2 * i) for i in range(6)], "row_id long, a long, b long, c long")
    got = {r.row_id: r.fm for r in N.fm_interaction(df, _emb(spark), ["a", "b", "c"], 4).collect()}
    wide = N.lookup_fields(df, _emb(spark), ["a", "b", "c"], 4)
    v = N.fm_second_order([F.col(f"v_{f}") for f in ("a", "b", "c")])
    assert got == {r.row_id: r.v for r in wide.select("row_id", v.alias("v")).collect()} and got[3] is None


def test_repeated_keys_and_weights_and_null_elements(spark):
    df = spark.createDataFrame([(1, "1 2"), (1, "3"), (2, "0"), (3, "1")], "row_id long, c string")
    emb = _emb(spark, [*EMB, (2, [3.0, None]), (1, None)])
    # row 1 holds three tokens, two of them of vector 3 and 2; vector 2 comes twice
    places = {r: [(t % 4 * 31) % 4 for t in ts] for r, ts in {1: [1, 2, 3], 2: [0], 3: [1]}.items()}
    table = {0: [[1.0, 0.5]], 1: [[0.0, 1.0]], 2: [[1.0, -1.0], [3.0, 0.0]], 3: [[2.0, 0.0]]}
    got = {r.row_id: r.pooled for r in N.mean_pool(df, emb, "c", 4, width=2).collect()}
    for r, at in places.items():
        assert got[r] == [sum(v[d] for p in at for v in table[p]) / 2 for d in range(2)]
    null = _emb(spark, [(0, [1.0, None]), (1, [None, None])])
    pooled = N.mean_pool(spark.createDataFrame([(1, "0"), (2, "3")], "row_id long, c string"), null, "c", 4, width=1).collect()
    assert {r.row_id: r.pooled for r in pooled} == {1: [1.0, None], 2: [None, None]}


def test_no_vector_is_sorted_or_aggregated_by_row(spark):
    df = spark.createDataFrame([(1, 2, 3, "1 2"), (2, 2, 3, "-1")], "row_id long, a long, b long, c string")
    made = [N.mean_pool(df, _emb(spark), "c", 4), N.attention_pool(df, _emb(spark), "a", "c", 4),
            N.ffm_interaction(df, _emb(spark), ["a", "b"], 4), N.lookup_fields(df, _emb(spark), ["a", "b"], 4),
            N.pairwise_sums(df, _emb(spark), ["a", "b"], 4, N.outer_rows)]
    for out in made:
        assert "Aggregate" not in _text(out) and "Window" not in _text(out) and _text(out).count("Join ") == 1
        assert out.count() == 2


def test_blocks_across_batches(spark):
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame([(i // 2, str(i)) for i in range(40)], "row_id long, c string")
        got = {r.row_id: r.pooled for r in N.mean_pool(df, _emb(spark), "c", 4, width=1).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    assert got == {k: (_at(2 * k, 0) + _at(2 * k + 1, 0)).tolist() for k in range(20)}

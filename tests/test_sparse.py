"""Sparse rows: vocabulary table, CSR blocks, readers, against brute force."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from fieldcraft.operators import sparse
from fieldcraft.operators.encode import FieldSpec

SPECS = [FieldSpec("x", "continuous"), FieldSpec("cat", "single"), FieldSpec("kw", "multi"), FieldSpec("n", "continuous")]


def data(n=300):
    r = np.random.default_rng(2)
    toks = ["Ab", "ab", "c-d", "é9", "under_score", "x", "日本", "rare"]
    out = []
    for i in range(n):
        kw = " ,;"[i % 3].join(toks[int(t)] for t in r.integers(0, 7, r.integers(0, 5)))
        out.append((i * 7, None if i % 11 == 0 else f"c{int(r.integers(0, 4))}", None if i % 13 == 0 else kw,
                    0.0 if i % 5 == 0 else round(float(r.random()), 3), None if i % 3 else float(i), int(r.random() < 0.4)))
    return out


def brute(rows, train, min_df):
    word = lambda t: re.findall(r"\w+", (t or "").lower())
    cats = sorted({r[1] for r in train if r[1] is not None})
    df = {}
    for r in train:
        for t in set(word(r[2])):
            df[t] = df.get(t, 0) + 1
    toks = sorted((t for t in df if df[t] >= min_df), key=lambda t: t.encode())
    idx = {("cat", c): 2 + i for i, c in enumerate(cats)} | {("kw", t): 2 + len(cats) + i for i, t in enumerate(toks)}
    out = {}
    for ident, cat, kw, x, n, _ in rows:
        v = {}
        for i, num in ((0, x), (1, n)):
            if num:
                v[i] = float(num)
        for key in [("cat", cat), *[("kw", t) for t in word(kw)]]:
            if key in idx:
                v[idx[key]] = v.get(idx[key], 0.0) + 1.0
        out[ident] = dict(sorted(v.items()))
    return out, 2 + len(idx)


@pytest.fixture(scope="module")
def made(spark):
    rows = data()
    df = spark.createDataFrame(rows, "row_id long, cat string, kw string, x double, n double, label int").repartition(5)
    train = df.filter("row_id < 1400")
    vocab = sparse.fit_vocabulary(train, SPECS, min_df=20).cache()
    want, width = brute(rows, [r for r in rows if r[0] < 1400], 20)
    return df, vocab, want, width


@pytest.mark.parametrize("n_blocks", [1, 7])
def test_blocks_equal_brute_force(spark, made, n_blocks, tmp_path):
    df, vocab, want, width = made
    assert sparse.size(vocab) == width
    blocks = sparse.encode_blocks(df, SPECS, vocab, n_blocks)
    blocks.write.parquet(str(tmp_path / "b"))
    again = spark.read.parquet(str(tmp_path / "b"))
    assert again.count() <= n_blocks
    got = {r.row_id: dict(zip(r.indices, r.vals)) for r in sparse.block_rows(again).collect()}
    assert got == want and all(list(v) == sorted(v) for v in got.values())


def test_vectors_feed_a_model(spark, made):
    df, vocab, want, width = made
    vec = sparse.block_vectors(sparse.encode_blocks(df, SPECS, vocab, 3), width)
    for r in vec.collect():
        assert r.features.size == width
        assert dict(zip(r.features.indices.tolist(), r.features.values.tolist())) == want[r.row_id]
    model = LogisticRegression(maxIter=5).fit(vec.join(df.select("row_id", "label"), "row_id"))
    assert model.numFeatures == width


def test_plan_keeps_the_vocabulary_off_the_driver(spark):
    """A vocabulary of more values than the driver is ever told: lookups are joins,
    and the vocabulary is a table of one row per value."""
    n = 30_000
    df = spark.range(n).select(F.col("id").alias("row_id"), F.concat(F.lit("v"), F.col("id")).alias("cat"),
                               F.lit(None).cast("string").alias("kw"), F.lit(1.0).alias("x"), F.lit(1.0).alias("n"))
    vocab = sparse.fit_vocabulary(df, SPECS)
    assert sparse.size(vocab) == n + 2
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = sparse.entries(df, SPECS, vocab)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert len(plan) < 20_000 and found.count() == 3 * n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_empty_table(spark, made):
    df, vocab, _, _ = made
    none = df.limit(0)
    assert sparse.block_rows(sparse.encode_blocks(none, SPECS, vocab, 2)).count() == 0
    empty = sparse.fit_vocabulary(none, SPECS)
    assert sparse.size(empty) == 2
    got = sparse.block_rows(sparse.encode_blocks(df, SPECS, empty, 2))
    assert got.count() == df.count() and got.agg(F.max(F.size("indices"))).first()[0] <= 2


def test_blocks_follow_the_rows(spark):
    assert sparse.n_blocks(spark.range(sparse.BLOCK_ROWS * 3 + 1)) == 4
    assert sparse.n_blocks(spark.range(0), 8) == 8

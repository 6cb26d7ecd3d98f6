"""Inputs that ordinary data holds and the driver tables do not."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcraft import session
from fieldcraft.functions import text
from fieldcraft.operators import counts, embed, evaluate, prep, target
from fieldcraft.sources import files


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---- priors

def fit_by_hand(hist, iters=1000, eps=1e-3):
    n, c, m = (np.array(x, float) for x in zip(*hist))
    a = b = 1.0
    psi = target._digamma_np
    for _ in range(iters):
        den = np.sum(m * (psi(n + a + b) - psi(a + b)))
        na = a * np.sum(m * (psi(c + a) - psi(a))) / den
        nb = b * np.sum(m * (psi(n - c + b) - psi(b))) / den
        if abs(na - a) < eps and abs(nb - b) < eps:
            break
        a, b = na, nb
    return a, b


def test_prior_with_null_and_two_group_columns(spark):
    hists = {("x", 1): [(10, 1, 3), (20, 4, 2), (5, 1, 4)], (None, 1): [(9, 3, 5), (30, 6, 1)],
             ("x", None): [(7, 2, 2), (8, 1, 9)]}
    df = spark.createDataFrame([(*g, *h) for g, hs in hists.items() for h in hs],
                               "g string, f int, n long, c long, m long")
    got = {(r.g, r.f): (r.alpha, r.beta) for r in target.beta_prior_fpi(df, ["g", "f"]).collect()}
    assert set(got) == set(hists)
    for g, hs in hists.items():
        assert got[g] == pytest.approx(fit_by_hand(hs), rel=1e-9)


def test_fitted_out_of_fold_rate(spark):
    r = np.random.default_rng(0)
    data = [(i, f"c{r.integers(5)}", None if i % 11 == 0 else int(r.integers(4)), i % 5, int(r.random() < .3), "train")
            for i in range(300)]
    df = spark.createDataFrame(data, "row_id long, a string, b int, fold int, label int, split string")
    train = F.col("split") == "train"
    got = target.oof_smoothed_rate(df, [["a", "b"]], ["row_id"], train, fit_prior=True)
    assert got.count() == 300
    want = {}
    for fold in range(5):
        per = {}
        for _, a, b, f, y, _ in data:
            if f != fold:
                s, n = per.get((a, b), (0, 0))
                per[a, b] = (s + y, n + 1)
        al, be = fit_by_hand([(n, s, 1) for s, n in per.values()])
        for i, a, b, f, _, _ in data:
            if f == fold:
                s, n = per.get((a, b), (0, 0))
                want[i] = 100 * (s + al) / (n + al + be)
    for x in got.collect():
        assert x.a_b_stas == pytest.approx(want[x.row_id], abs=1e-6)


def test_crosses_do_not_share_keys(spark):
    df = spark.createDataFrame([("a_b", "c"), ("a", "b_c"), (None, "x"), ("nan", "x"), ("x", None)], "p string, q string")
    assert df.select(text.cross_key("p", "q").alias("k")).distinct().count() == 5
    both = df.withColumn("row_id", F.monotonically_increasing_id())
    codes = counts.cross_encode(both, [("p", "q")], times=1).filter("p IS NULL OR q IS NULL").select("p_q")
    assert codes.distinct().count() == 2


# ---- numbers and ids

def test_lenient_numbers(spark):
    df = spark.createDataFrame([("nan",), ("1e20",), ("99999999999",), ("7.9",), ("x",), ("",), (None,), ("inf",)], "v string")
    got = [r[0] for r in df.select(text.lenient_int("v")).collect()]
    assert got == [None, None, 99999999999, 7, None, None, None, None]


@pytest.mark.parametrize("i", [4_000_000_000, 9_000_000_000_000_000_000, -5])
def test_large_ids_hash(spark, i):
    df = spark.createDataFrame([(i,)], "id long")
    assert df.select(prep.mult_hash("id", 2018)).first()[0] == ((i % 2**31) * 2654435761 + 2018) % 2**32
    assert df.select(embed.vec_id(F.col("id"), 3, 500)).first()[0] == ((i % 500) * 31 + 3) % 500


# ---- nulls keep their rows

def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, row_id long")
    got = {r.row_id: r.rank0 for r in prep.rank_within(df, ["k"], ["row_id"]).collect()}
    assert got == {1: 0, 2: 0, 3: 1}
    lab = spark.createDataFrame([(i, None if i < 10 else i % 2) for i in range(30)], "row_id long, label int")
    got = rows(prep.stratified_split(lab, "row_id").groupBy("label", "part").count(), "label", "part")
    assert got == [(None, "test", 2), (None, "train", 8), (0, "test", 2), (0, "train", 8), (1, "test", 2), (1, "train", 8)]


def test_scores_with_null_model_and_one_class(spark):
    df = spark.createDataFrame([("m", .1, 0), ("m", .9, 1), (None, .3, 1), (None, .2, 0), ("one", .5, 1)],
                               "model string, score double, label int")
    got = {r.model: r.auc for r in evaluate.exact_auc(df, group=["model"]).collect()}
    assert got == {"m": 1.0, None: 1.0, "one": None}
    ranked = evaluate.rank_desc_avg(df, group=["model"])
    assert sorted((r.model or "", r.rank) for r in ranked.collect()) == [("", 1.0), ("", 2.0), ("m", 1.0), ("m", 2.0), ("one", 1.0)]


def test_best_by_metric(spark):
    third = 1 / 3
    df = spark.createDataFrame([("a", 1, .5), ("a", 2, third + third), ("a", 3, third + third), ("b", 1, None), ("b", 2, .1)],
                               "model string, epoch int, auc double")
    assert rows(evaluate.best_by_metric(df), "model") == [("a", 2, third + third), ("b", 2, .1)]


def test_lookup_keeps_rows_with_nulls(spark):
    emb = spark.createDataFrame([(i, [float(i)]) for i in range(4)], "vec_id long, vec array<double>")
    df = spark.createDataFrame([(1, 2, 3), (2, None, 3)], "row_id long, a long, b long")
    got = {r.row_id: (r.v_a, r.v_b) for r in embed.lookup_fields(df, emb, ["a", "b"], 4).collect()}
    assert got[2][0] is None and got[2][1] is not None and got[1][0] is not None


# ---- files

def test_profile_line_that_repeats_a_key(spark, tmp_path):
    spark.createDataFrame([("uid 7|kw 1 2|age 3|kw 9",)], "value string").write.text(str(tmp_path / "p"))
    got = files.read_profile(spark, str(tmp_path / "p")).first().profile
    assert got == {"uid": ["7"], "kw": ["9"], "age": ["3"]}


def test_csv_keeps_null_doubles(spark, tmp_path):
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("label", T.LongType())])
    df = spark.createDataFrame([(0.5, 1), (None, 0)], schema)
    files.write_csv(df, str(tmp_path / "c"))
    assert sorted(rows(files.read_csv(spark, str(tmp_path / "c"), schema)), key=str) == [(0.5, 1), (None, 0)]


def test_lines_follow_part_numbers_and_folders(spark, tmp_path):
    for folder, part, lines in (("a", "part-99999", "1\n2\n"), ("a", "part-100000", "3\n"), ("b", "part-00000", "4\n")):
        os.makedirs(tmp_path / folder, exist_ok=True)
        (tmp_path / folder / f"{part}.csv").write_text(lines)
    got = files.read_lines_with_position(spark, str(tmp_path / "*"), T.StructType([T.StructField("v", T.IntegerType())]))
    assert [r.v for r in got.orderBy("pos").collect()] == [1, 2, 3, 4]


# ---- shared folder and broadcasts

def test_private_folder_only_for_local_masters():
    assert os.path.isdir(session.private_folder("local[2]"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.private_folder(master)


def test_long_values_are_not_broadcast(spark):
    small = spark.createDataFrame([("a", 1)], "k string, v int")
    wide = spark.range(30).select(F.repeat(F.lit("x"), 500_000).alias("k"), F.lit(1).alias("v"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(session.broadcast_if_small(small)) and not hinted(session.broadcast_if_small(wide))
    assert session.measured_bytes(wide) >= 15_000_000


def test_scratch_tables_are_dropped(spark):
    t = session.materialize(spark.range(5).toDF("id"), "gone")
    folder = os.path.dirname(t.inputFiles()[0].replace("file://", ""))
    assert t.count() == 5 and os.path.isdir(folder)
    session.drop_scratch(t)
    assert not os.path.isdir(folder)


def test_materialize_once(spark, tmp_path):
    path = str(tmp_path / "once")
    assert files.materialize_once(spark.range(3), path).count() == 3
    assert files.materialize_once(spark.range(9), path).count() == 3  # the first output stays


def test_cross_codes_without_pivot(spark):
    from fieldcraft.operators import counts as C
    rows = [(i, "a" if i < 6 else f"b{i}", None if i == 3 else 1, i % 2) for i in range(12)]
    df = spark.createDataFrame(rows, "row_id long, x string, y int, z int")
    out = C.cross_encode(df, [("x", "y"), ("x", "z"), ("y", "z")], 3)
    got = {r.row_id: (r.x_y, r.x_z, r.y_z) for r in out.collect()}
    # x_y: '-1' and 'a_1'; x_z: '-1', 'a_0', 'a_1'; y_z: '-1', '1_0', '1_1'
    for i, x, y, z in rows:
        assert got[i] == (int(x == "a" and y == 1), 1 + z if x == "a" else 0, 0 if y is None else 1 + z)
    assert "PivotFirst" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_priors_are_fitted_by_several_tasks(spark):
    hist = spark.createDataFrame([(g, n, n % 3, 5) for g in range(40) for n in range(3, 9)], "g int, n int, c int, m int")
    out = target.beta_prior_fpi(hist, ["g"])
    assert out.count() == 40 and out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    one = target.beta_prior_fpi(hist.filter("g = 7"), ["g"]).first()
    assert [tuple(r)[1:] for r in out.filter("g = 7").collect()] == [tuple(one)[1:]]

"""Hand-computed cases for the traps of each operator family, and invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcraft.functions.numeric import digamma, digitize_right, UID_CONVERT_EDGES
from fieldcraft.functions.ordered import global_position, global_prefix_sum
from fieldcraft.operators import counts as C
from fieldcraft.operators import encode as EN
from fieldcraft.operators import evaluate as V
from fieldcraft.operators import ordered as O
from fieldcraft.operators import prep as P
from fieldcraft.operators import target as T


def test_digitize_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in [-1.0, 0.0, 0.05, 0.1, 1.0, 2.0]], "x double")
    got = [r[0] for r in df.select(digitize_right("x", UID_CONVERT_EDGES)).collect()]
    assert got == [0, 1, 2, 2, 6, 7]
    assert got == list(np.digitize([-1, 0, .05, .1, 1, 2], UID_CONVERT_EDGES, right=True))


def test_digamma_integer_identity(spark):
    # psi(n + a) - psi(a) = sum_{j<n} 1/(a+j)
    rows = [(a, n) for a in (0.001, 0.3, 1.0, 3.3) for n in (1, 5, 40)]
    df = spark.createDataFrame(rows, "a double, n int")
    got = df.select("a", "n", (digamma(F.col("a") + F.col("n")) - digamma("a")).alias("d")).collect()
    for r in got:
        want = sum(1.0 / (r["a"] + j) for j in range(r["n"]))
        assert abs(r["d"] - want) < 1e-7 * max(1.0, want)


def test_positional_split_drops_middle_row(spark):
    df = spark.range(13).withColumnRenamed("id", "row_id")
    out = {r["row_id"]: r["part"] for r in P.positional_split(df, "row_id").collect()}
    assert sorted(k for k, v in out.items() if v == "head") == list(range(9))   # int(0.7*13) = 9
    assert sorted(k for k, v in out.items() if v == "tail") == [10, 11, 12]     # int(0.3*13) = 3
    assert 9 not in out


def test_global_position_and_prefix(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(1000)], "k long, v double")
    pos = {r["k"]: r["pos"] for r in global_position(df, ["k"], "pos", num_partitions=7).collect()}
    assert all(pos[k] == k for k in range(1000))
    ps = global_prefix_sum(df, ["k"], ["v"], ["cv"], num_partitions=5).collect()
    exp = np.cumsum([i % 3 for i in range(1000)]) - np.array([i % 3 for i in range(1000)])
    assert all(abs(r["cv"] - exp[r["k"]]) < 1e-9 for r in ps)


def test_label_encode_keeps_crosses_distinct(spark):
    df = spark.createDataFrame([("1_23",), ("12_3",), ("1_23",)], "c string")
    out = C.label_encode(df, "c", "e").collect()
    assert len({r["e"] for r in out}) == 2


def test_zscore_constant_column(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 5)], "k int, v int")
    out = C.nunique_zscore(df, "k", "v", "z").collect()
    assert all(r["z"] == 0.0 for r in out)


def test_distinct_counts_are_dealt_by_their_values(spark, monkeypatch):
    rows = [(i % 7 if i < 600 else 0, i % 40 if i < 600 else 1, None if i % 9 == 0 else f"v{i % 25}") for i in range(1200)]
    df = spark.createDataFrame([(None if k == 3 else k, a, b) for k, a, b in rows], "k int, a int, b string").coalesce(1)
    specs = [("k", "a", "ka"), ("k", "b", "kb"), ("b", "a", "ba")]
    want = sorted(map(str, C.nunique_recipe(df, specs).collect()))
    monkeypatch.setattr(C, "TASK_VALUES", 100)
    dealt = C.deal_values(df, df.columns, 2 * 1200)
    sizes = dealt.rdd.glom().map(len).collect()
    assert len(sizes) == 24 and max(sizes) < 200 and sum(sizes) == 1200  # half of all rows have equal k and a
    assert sorted(map(str, C.nunique_recipe(df, specs).collect())) == want
    assert C.deal_values(df, df.columns, 90).rdd.getNumPartitions() == 1


def test_user_conversion_leave_one_out(spark):
    rows = [(0, 1, 10, 1, "train"), (1, 1, 11, 0, "train"), (2, 1, 10, 0, "train"),
            (3, 2, 10, 1, "train"), (4, 1, 12, 0, "test"), (5, 3, 10, 0, "test")]
    df = spark.createDataFrame(rows, "row_id long, uid long, aid int, label int, split string")
    out = {r["row_id"]: r for r in
           T.user_conversion_loo(df, ["row_id"], F.col("split") == "train").collect()}
    # row 0: lists pos [10], neg [11, 10]; own aid 10 removed once from each -> pos 0, neg 1
    assert (out[0]["pos_num"], out[0]["neg_num"], out[0]["uid_convert"]) == (0, 1, 0.0)
    assert out[3]["uid_convert"] == -1.0            # only row of the user
    assert out[4]["uid_convert"] == pytest.approx(1 / 3)
    assert out[5]["uid_convert"] == -1.0            # unknown user


def test_oof_rate_ignores_own_label(spark):
    rows = [(i, i % 5, ["a", "b"][i % 2], i % 3 == 0) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, fold long, k string, y boolean") \
              .withColumn("label", F.col("y").cast("int")).withColumn("split", F.lit("train"))
    flip = df.withColumn("label", F.when(F.col("row_id") == 7, 1 - F.col("label")).otherwise(F.col("label")))
    a = T.oof_smoothed_rate(df, [("k",)], ["row_id"], F.col("split") == "train").filter("row_id = 7").first()
    b = T.oof_smoothed_rate(flip, [("k",)], ["row_id"], F.col("split") == "train").filter("row_id = 7").first()
    assert a["k_stas"] == b["k_stas"]


def test_fold_without_other_rows_gets_prior(spark):
    df = spark.createDataFrame([(0, 0, "x", 1)], "row_id long, fold long, k string, label int") \
              .withColumn("split", F.lit("train"))
    r = T.oof_smoothed_rate(df, [("k",)], ["row_id"], F.col("split") == "train").first()
    assert r["k_stas"] == 50.0


def test_noisy_or_long_list(spark):
    rows = [(0, "u", 1, "train"), (1, "u", 0, "train"), (2, " ".join(["u"] * 1000), 0, "test"),
            (3, " ".join(["u"] * 2000), 0, "test"), (4, "-1", 0, "test"), (5, "zz", 0, "test")]
    df = spark.createDataFrame(rows, "row_id long, c string, label int, split string")
    out = {r["row_id"]: r["c_score"] for r in
           T.token_noisy_or(df, "c", "row_id", F.col("split") == "train", ["row_id"], digits=320).collect()}
    # token u: cnt 2, pos 1 -> factor 1 - 2/4 = 0.5 per occurrence
    assert out[0] == 0.5
    assert out[2] == pytest.approx(0.5 ** 1000, rel=1e-9)   # 9.3e-302, representable
    assert out[3] == 0.0                                    # below the double range, as a float product
    assert out[4] == -1.0                                   # missing cell
    assert out[5] == 1.0                                    # no scoring token


def test_beta_prior_matches_numpy_iteration(spark):
    hist = spark.createDataFrame([(10.0, 1.0, 3.0), (20.0, 4.0, 2.0), (5.0, 0.0, 4.0)], "n double, c double, m double")
    got = T.beta_prior_fpi(hist, (), iters=50, eps=1e-10).first()
    n, c, m, a, b = np.array([10., 20., 5.]), np.array([1., 4., 0.]), np.array([3., 2., 4.]), 1.0, 1.0
    psi = T._digamma_np
    for _ in range(50):
        den = np.sum(m * (psi(n + a + b) - psi(a + b)))
        na, nb = a * np.sum(m * (psi(c + a) - psi(a))) / den, b * np.sum(m * (psi(n - c + b) - psi(b))) / den
        if abs(na - a) < 1e-10 and abs(nb - b) < 1e-10:
            break
        a, b = na, nb
    assert got["alpha"] == pytest.approx(a, rel=1e-9) and got["beta"] == pytest.approx(b, rel=1e-9)


def test_dup_flags(spark):
    rows = [(0, 1, 1, 1), (1, 1, 1, 0), (2, 1, 1, 1), (3, 2, 2, 0)]
    df = spark.createDataFrame(rows, "row_id long, uid long, aid int, label int")
    out = {r["row_id"]: (r["maybe_0"], r["maybe_1"], r["maybe_2"], r["maybe_3"], r["large2"])
           for r in O.dup_flags(df, ["uid", "aid"], "row_id").collect()}
    assert out == {0: (0, 0, 1, 0, 1), 1: (0, 1, 0, 0, 1), 2: (0, 0, 0, 1, 1), 3: (1, 0, 0, 0, 0)}


def test_running_rank_hot_key(spark):
    rows = [(i, 1 if i % 3 else 2) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, k long")
    out = O.running_rank(df, "k", "row_id", "r").toPandas().sort_values("row_id")
    want = out.groupby("k").cumcount() + 1
    assert (out["r"].values == want.values).all()


def test_rank_average_ties_and_auc(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.5, 0), (0.5, 0), (0.1, 1), (0.1, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    ranks = sorted(r["rank"] for r in V.rank_desc_avg(df, "score").collect())
    assert ranks == [1.0, 2.5, 2.5, 4.5, 4.5, 6.5, 6.5]
    auc = V.exact_auc(df).first()["auc"]
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute)
    ml = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    assert auc == pytest.approx(ml)


def test_frequency_vocab_dense_disjoint(spark):
    rows = [(i, str(i % 4), " ".join(str(j) for j in range(i % 5)) or "-1") for i in range(400)]
    df = spark.createDataFrame(rows, "row_id long, a string, t string")
    specs = [EN.FieldSpec("a", "single", True), EN.FieldSpec("t", "multi", True)]
    voc = EN.frequency_vocab(EN.value_counts_all(df, specs), specs, threshold=50).collect()
    idx = sorted(r["idx"] for r in voc)
    assert idx == list(range(1, len(idx) + 1))
    assert all(r["value"] != "0" for r in voc)


def test_pair_token_max_counts_every_pair(spark):
    rows = [(0, "a b", "x"), (1, "a", "x"), (2, "b b", "y")]
    df = spark.createDataFrame(rows, "row_id long, l string, r string")
    out = {r["row_id"]: r["l_r_pair_max"] for r in O.pair_token_max(df, "l", "r", "row_id", ["row_id"]).collect()}
    assert out == {0: 2, 1: 2, 2: 2}


def test_label_history(spark):
    rows = [(i, 1, i % 2) for i in range(6)]
    tr = spark.createDataFrame(rows, "row_id long, uid long, label int").withColumn("split", F.lit("train"))
    te = spark.createDataFrame([(10, 1, 0), (11, 9, 0)], "row_id long, uid long, label int") \
              .withColumn("split", F.lit("test"))
    out = {r["row_id"]: (r["seq"], r["seq_idx"]) for r in
           O.label_history_seq(tr, te, "uid", "row_id", keep=["row_id"]).collect()}
    assert out[0] == ("", 0)
    assert out[5][0] == "1 0 1 0"
    assert out[10][0] == "0 1 0 1"
    assert out[11] == ("", 0)


def _emb4(spark):
    # vec_id(value, slot, 4) = pmod(value * 31 + slot, 4)
    return spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [2.0, 0.0])],
                                 "vec_id long, vec array<double>")


def test_mean_pool_padding_and_empty_cells(spark):
    from fieldcraft.operators import embed as N
    df = spark.createDataFrame([(1, "1 2"), (2, "-1"), (3, "4 x"), (4, "1")], "row_id long, c string")
    zero = {r["row_id"]: r["pooled"] for r in N.mean_pool(df, _emb4(spark), "c", 4).collect()}
    assert zero == {1: [1.5, 0.5], 2: [0.0, 0.0], 3: [0.5, 0.0], 4: [1.0, 0.0]}   # width 2
    skip = {r["row_id"]: r["pooled"] for r in N.mean_pool(df, _emb4(spark), "c", 4, pad="skip").collect()}
    assert skip == {1: [1.5, 0.5], 2: [0.0, 0.0], 3: [1.0, 0.0], 4: [2.0, 0.0]}


def test_attention_pool_softmax_and_missing(spark):
    from fieldcraft.operators import embed as N
    df = spark.createDataFrame([(1, 1, "1 2"), (2, 1, "-1"), (3, None, "1"), (4, 2, "1 x")],
                               "row_id long, q int, c string")
    got = {r["row_id"]: r["att"] for r in N.attention_pool(df, _emb4(spark), "q", "c", 4).collect()}
    w1, w2 = math.exp(math.sqrt(2)), math.exp(2 * math.sqrt(2))   # q=[2,0]; keys [1,0], [2,0]
    assert got[1] == pytest.approx([(w1 + 2 * w2) / (w1 + w2), 0.0])
    assert got[2] == [0.0, 0.0] and got[3] == [0.0, 0.0]
    assert got[4] == pytest.approx([1.0, 0.0])


def test_broadcast_if_small_checks_measured_size(spark):
    from fieldcraft.session import broadcast_if_small
    df = spark.range(10)
    lim = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        small = spark.range(100).join(broadcast_if_small(df, 10, 64), "id")      # 640 bytes: broadcast
        large = spark.range(100).join(broadcast_if_small(df, 1000, 64), "id")    # 64k: not hinted
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", lim)


def test_pmi_single_matches_direct_formula(spark):
    from fieldcraft.operators import info as I
    rows = [(i, i % 3, ["a", "b"][i % 2], i % 4) for i in range(24)]
    df = spark.createDataFrame(rows, "row_id long, c int, x string, y int")
    got = {r["row_id"]: (r["new_inf_c_x"], r["new_inf_c_y"])
           for r in I.pmi_single(df, "c", ["x", "y"], bucket=False).collect()}
    n = len(rows)
    for rid, c, x, y in rows:
        for v, col, want_i in ((x, 2, 0), (y, 3, 1)):
            cj = sum(1 for r in rows if r[col] == v)
            ci = sum(1 for r in rows if r[1] == c)
            cij = sum(1 for r in rows if r[1] == c and r[col] == v)
            assert got[rid][want_i] == pytest.approx(math.log1p(cj * ci / cij / n))


def test_ffm_encoders_keep_rows_without_entries(spark):
    specs = [EN.FieldSpec("a", "single", numeric=True), EN.FieldSpec("t", "multi")]
    df = spark.createDataFrame([(1, "3", "x y", 1), (2, "0", "-1", 0), (3, "9", "z", 0)],
                               "row_id long, a string, t string, label int")
    voc = EN.sorted_vocab(df, specs)
    got = {r["row_id"]: r["line"] for r in EN.sorted_encode(df, specs, voc).collect()}
    assert set(got) == {1, 2, 3} and got[2] == ""          # zero single and missing cell: no entries
    fv = spark.createDataFrame([("a", "3", 0, 1), ("t", "x", 1, 2)], "field string, value string, field_id int, idx int")
    lines = {r["row_id"]: r["line"] for r in EN.ffm_lines(df, specs, fv).collect()}
    assert lines == {1: "1 0:1:1 1:2:1", 2: "0", 3: "0"}


def test_pmi_tokens_empty_cell_and_null_cond(spark):
    from fieldcraft.operators import info as I
    rows = [(1, 1, "a b"), (2, 1, "a"), (3, 2, "b"), (4, 2, ""), (5, None, "a")]
    df = spark.createDataFrame(rows, "row_id long, c int, kw string")
    got = {r["row_id"]: r for r in I.pmi_tokens(df, "c", "kw", bucket=False).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[4]["new_inf_c_kw_max"] is None and got[5]["new_inf_c_kw_mintok"] is None
    # row 1: p(a) = cc(1)=2 * b(a)=3 / ct(1,a)=2 / N=5 ; p(b) = 2 * 2 / 1 / 5
    pa, pb = 2 * 3 / 2 / 5, 2 * 2 / 1 / 5
    assert got[1]["new_inf_c_kw_max"] == pytest.approx(math.log1p(pa * pb))
    assert got[1]["new_inf_c_kw_mean"] == pytest.approx(math.log1p(pa * pb) / 2)
    assert got[1]["new_inf_c_kw_mintok"] == pytest.approx(math.log1p(min(pa, pb)))


def test_pairwise_vectors_element_by_element(spark):
    from fieldcraft.operators import embed as N
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 5.0])], "a array<double>, b array<double>")
    got = df.select(N.hadamard(F.col("a"), F.col("b")), N.outer(F.col("a"), F.col("b")),
                    N.pair_diff(F.col("a"), F.col("b")), N.fm_second_order([F.col("a"), F.col("b")])).first()
    assert [list(v) for v in got] == [[3.0, 10.0], [3.0, 5.0, 6.0, 10.0], [1.0, 2.0, -2.0, -3.0, 3.0, 5.0], [3.0, 10.0]]
    s = df.select(*N.summarize(F.col("b"))).first()
    assert (s.vsum, s.vsq, s.vpos) == (8.0, 34.0, 13.0)


def test_ffm_by_field_and_with_nulls(spark):
    from fieldcraft.operators import embed as N
    emb = _emb4(spark)
    table = {r["vec_id"]: r["vec"] for r in emb.collect()}
    fields, rows = ["a", "b", "c"], [(1, 1, 2, 3), (2, 5, None, 7)]
    df = spark.createDataFrame(rows, "row_id long, a long, b long, c long")

    def vec(value, slot):
        return None if value is None else table[(value % 4 * 31 + slot) % 4]

    for self_pairs in (False, True):
        whole = {r["row_id"]: r["ffm"] for r in N.ffm_interaction(df, emb, fields, 4, include_self=self_pairs).collect()}
        each = {r["row_id"]: [r[f"ffm_{f}"] for f in fields] for r in
                N.ffm_interaction(df, emb, fields, 4, include_self=self_pairs, per_field=True).collect()}
        for rid, *vals in rows:
            total, per = [0.0, 0.0], [[0.0, 0.0] for _ in fields]
            for i in range(3):
                for k in range(i if self_pairs else i + 1, 3):
                    u, v = vec(vals[i], 3 * i + k), vec(vals[k], 3 * k + i)
                    if u and v:
                        for d in range(2):
                            total[d] += u[d] * v[d]
                            for j in {i, k}:
                                per[j][d] += u[d] * v[d]
            assert whole[rid] == total and each[rid] == per


def test_ffm_joins_the_weights_once(spark):
    from fieldcraft.operators import embed as N
    names = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(range(7))], "row_id long, " + ", ".join(f"{n} long" for n in names))
    for k in (2, 6):
        plan = N.ffm_interaction(df, _emb4(spark), names[:k], 4)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 1


def test_lookup_by_vocabulary_and_linear_scorer(spark):
    from fieldcraft.operators import embed as N
    vocab = spark.createDataFrame([("a", "x", 2), ("a", "y", 3), ("b", "7", 0)], "field string, value string, idx int")
    df = spark.createDataFrame([(1, "x", 7), (2, "z", None), (3, "y", 8)], "row_id long, a string, b long")
    got = {r["row_id"]: (r["v_a"], r["v_b"]) for r in N.lookup_fields(df, _emb4(spark), ["a", "b"], vocab=vocab).collect()}
    assert got == {1: ([1.0, 1.0], [1.0, 0.0]), 2: (None, None), 3: ([2.0, 0.0], None)}
    cells = spark.createDataFrame([(1, 1, "1 2")], "row_id long, q int, c string")
    w = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]
    att = N.attention_pool(cells, _emb4(spark), "q", "c", 4, scorer=N.linear_scorer(w, 0.5)).first()["att"]
    q, keys = [2.0, 0.0], [[1.0, 0.0], [2.0, 0.0]]
    # the constant 0.5 leaves the softmax as it is; scores are divided by the root of the dimension
    s = [sum(a * b for a, b in zip(w, [*q, *k, q[0] - k[0], q[1] - k[1], q[0] * k[0], q[1] * k[1]])) / math.sqrt(2)
         for k in keys]
    e = [math.exp(x - max(s)) for x in s]
    assert att == pytest.approx([(e[0] * 1 + e[1] * 2) / sum(e), 0.0])


def test_row_item_lists_drop_the_own_item_once(spark):
    rows = [(0, 1, 5, 1, "train"), (1, 1, 5, 1, "train"), (2, 1, 6, 0, "train"), (3, 1, 5, 0, "train"),
            (4, 1, 5, 0, "test"), (5, 2, 9, 0, "test")]
    df = spark.createDataFrame(rows, "row_id long, uid long, aid int, label int, split string")
    got = {r["row_id"]: (r["pos_aid"], r["neg_aid"]) for r in
           T.row_item_lists(df, ["row_id"], F.col("split") == "train").collect()}
    assert got == {0: ("5", "6"), 1: ("5", "6"), 2: ("5 5", "5"), 3: ("5", "6"), 4: ("5 5", "6 5"), 5: ("", "")}


def test_label_history_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(O, "BLOCK", 7)
    rows = [(i, None if i % 9 == 0 else i % 2, (i * i) % 3) for i in range(80)]
    tr = spark.createDataFrame(rows, "row_id long, uid long, label int")
    got = {r["row_id"]: r["seq"] for r in O.label_history_seq(tr, tr.limit(0), "uid", "row_id", keep=["row_id"]).collect()}
    past = {}
    assert len(got) == 80
    for i, u, y in rows:
        assert got[i] == " ".join(str(x) for x in past.get(u, [])[-4:]), i
        past.setdefault(u, []).append(y)

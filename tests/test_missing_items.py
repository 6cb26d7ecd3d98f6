"""Segmented lists, bounded pair counts, null cells, dense attention, mergeable
counts and sequential search against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import same
from fieldcraft.operators import embed as N
from fieldcraft.operators import ordered as O
from fieldcraft.operators import search as TS
from fieldcraft.operators import target as T
from fieldcraft.operators.partial import CountStore, Stat


# --- segmented lists ---------------------------------------------------------

def log(spark, n=600):
    """A third of all rows belong to user 1."""
    r = random.Random(4)
    rows = [(i, 1 if i % 3 == 0 else (None if i % 50 == 7 else r.randint(2, 9)), r.randint(0, 5), int(r.random() < 0.4),
             i % 5 != 0) for i in range(n)]
    return rows, spark.createDataFrame(rows, "row_id long, uid long, aid int, label int, is_train boolean").repartition(6)


def test_segments_rebuild_the_lists(spark):
    rows, df = log(spark)
    entries = T.ranked_items(df, F.col("is_train"))
    segments = T.list_segments(entries, 16).cache()
    got = segments.collect()
    assert max(len(r["items"]) for r in got) == 16 and all(len(r["items"]) == r.n for r in got)
    lists = {}
    for _, u, a, y, train in rows:
        if train:
            lists.setdefault((u, "pos" if y > 0 else "neg"), []).append(str(a))
    for key, want in lists.items():
        mine = sorted((r.segment, r["items"]) for r in got if (r.user, r.side) == key)
        assert [s for s, _ in mine] == list(range(len(mine))) and sum((i for _, i in mine), []) == want
    # rows read their lists without their own item
    pos = T.list_positions(df, entries, segments, ["row_id"], F.col("is_train"))
    by_row = {r.row_id: r for r in pos.collect()}
    cells = {}
    for r in T.read_lists(pos, segments, ["row_id"], 16).orderBy("row_id", "side", "segment").collect():
        cells.setdefault((r.row_id, r.side), []).extend(r["items"])
    assert len(by_row) == len(rows)
    for i, u, a, y, train in rows:
        num = []
        for side in ("pos", "neg"):
            want = list(lists.get((u, side), []))
            if train and str(a) in want:
                assert by_row[i][f"{side}_skip"] == want.index(str(a))
                want.remove(str(a))
            else:
                assert by_row[i][f"{side}_skip"] is None
            assert cells.get((i, side), []) == want
            num.append(len(want))
        assert [by_row[i].pos_num, by_row[i].neg_num] == num
        assert by_row[i].uid_convert == pytest.approx(num[0] / sum(num) if sum(num) else -1.0)


# --- pair counts and null cells ------------------------------------------------

@pytest.mark.parametrize("rounds", [1, 2, 4])
def test_bounded_pair_counts(spark, rounds):
    r = random.Random(5)
    zipf = lambda k: f"t{int(60 * r.random() ** 4)}" if k else f"u{int(40 * r.random() ** 4)}"
    # a few common tokens and a long tail in every cell
    tail = lambda k: [f"{k}x{r.randint(0, 900)}" for _ in range(r.randint(0, 5))]
    cells = [(i, None if i % 40 == 3 else " ".join([zipf(1) for _ in range(r.randint(1, 3))] + tail("t")),
              None if i % 37 == 5 else ",".join([zipf(0) for _ in range(r.randint(1, 3))] + tail("u"))) for i in range(500)]
    df = spark.createDataFrame(cells, "row_id long, a string, b string")
    count = Counter(f"{x}|{y}" for _, a, b in cells if a is not None and b is not None
                    for x in a.split(" ") for y in b.split(","))
    want = {i: max((count[f"{x}|{y}"] for x in a.split(" ") for y in b.split(",")), default=0)
            if a is not None and b is not None else 0 for i, a, b in cells}
    out, share = O.pair_token_max_bounded(df, "a", "b", ["row_id"], rounds=rounds)
    assert {x.row_id: x.a_b_pair_max for x in out.collect()} == want
    assert share == 1.0 if rounds == 1 else 0 < share < (0.7 if rounds == 4 else 1.0)
    plain = O.pair_token_max(df, "a", "b", "row_id", ["row_id"])
    assert {x.row_id: x.a_b_pair_max for x in plain.collect()} == want
    none, nothing = O.pair_token_max_bounded(df.limit(0), "a", "b", ["row_id"], rounds=rounds)
    assert none.count() == 0 and nothing == 0.0


def test_bounded_pair_counts_write_rows_not_tokens(spark, monkeypatch):
    cells = [(i, " ".join(f"a{(i * j) % 11}" for j in range(6)), f"b{i % 3},b{i % 4}") for i in range(60)]
    df = spark.createDataFrame(cells, "row_id long, a string, b string")
    written, real = [], O.materialize

    def spy(table, name):
        out = real(table, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(O, "materialize", spy)
    assert O.pair_token_max_bounded(df, "a", "b", ["row_id"])[0].count() == 60
    assert ("held", 60) in written  # one row per row, however many tokens it has


@pytest.mark.parametrize("mode,unseen", [("pos", 0), ("rate", 0.05)])
def test_null_cells_keep_their_row(spark, mode, unseen):
    rows = [(i, None if i % 4 == 1 else f"a b{i % 3}", int(i % 3 == 0)) for i in range(24)]
    df = spark.createDataFrame(rows, "row_id long, kw string, label int")
    got = T.contig_fold_token_max(df.filter("row_id < 16"), df.filter("row_id >= 16"), "kw", "row_id", ["row_id"], k=3, mode=mode)
    got = {r.row_id: r[f"kw_{mode}_max"] for r in got.collect()}
    assert len(got) == 24 and all(got[i] == unseen for i, kw, _ in rows if kw is None)


# --- attention -----------------------------------------------------------------

def test_attention_with_dense_layers(spark):
    r = np.random.default_rng(1)
    n, dim = 11, 4
    vecs = r.normal(size=(n, dim))
    emb = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id long, vec array<double>")
    layers = [(r.normal(size=(4 * dim, 5)), r.normal(size=5)), (r.normal(size=(5, 3)), r.normal(size=3)),
              (r.normal(size=(3, 1)), r.normal(size=1))]
    cells = [(0, 3, "1 2 5"), (1, 4, "-1"), (2, None, "7"), (3, 9, "8 8 x"), (4, 2, None), (5, 6, "10")]
    df = spark.createDataFrame(cells, "row_id long, q long, c string")
    table = [(k, -1, j, float(b[j])) for k, (_, b) in enumerate(layers) for j in range(len(b))]
    table += [(k, i, j, float(w[i, j])) for k, (w, _) in enumerate(layers) for i in range(w.shape[0]) for j in range(w.shape[1])]
    read = N.mlp_layers(spark.createDataFrame(table, "layer int, i int, j int, w double"))
    assert all(np.allclose(a, b) for x, y in zip(read, layers) for a, b in zip(x, y))
    got = {x.row_id: x.att for x in N.attention_pool(df, emb, "q", "c", n, mlp=read).collect()}
    sig = lambda z: 1 / (1 + math.exp(-z))
    at = lambda v, f: (v % n * 31 + f) % n
    for i, q, c in cells:
        toks = [int(t) for t in (c or "-1").split() if t.isdigit()]
        if q is None or not toks:
            assert got[i] == [0.0] * dim
            continue
        scores = []
        for t in toks:
            a, b = vecs[at(q, 0)], vecs[at(t, 1)]
            x = [*a, *b, *(a - b), *(a * b)]
            for k, (w, bias) in enumerate(layers):  # element by element
                x = [sum(x[p] * w[p][j] for p in range(len(x))) + bias[j] for j in range(len(bias))]
                x = [sig(z) for z in x] if k < 2 else x
            scores.append(x[0] / math.sqrt(dim))
        e = [math.exp(s - max(scores)) for s in scores]
        want = sum(w * vecs[at(t, 1)] for w, t in zip(e, toks)) / sum(e)
        assert got[i] == pytest.approx(list(want))


# --- mergeable counts ------------------------------------------------------------

STATS = [Stat("uid_aid", ("uid",), "aid"), Stat("aid_uid", ("aid",), "uid"), Stat("pair", ("uid", "aid"))]


def whole(df):
    out = None
    for s in STATS:
        from fieldcraft.functions.text import cross_key
        item = F.col(s.item) if s.item else F.lit(None)
        one = df.groupBy(F.lit(s.name).alias("stat"), cross_key(*s.keys).alias("key")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count(item).alias("n_items"), F.countDistinct(item).alias("n_distinct"))
        out = one if out is None else out.unionByName(one)
    return out


def test_parts_merge_to_the_whole(spark, tmp_path):
    _, df = log(spark)
    store = CountStore(spark, str(tmp_path / "s"), STATS, buckets=8)
    assert store.counts().count() == 0
    parts = [df.filter("row_id < 200"), df.filter("row_id >= 200 AND row_id < 590"), df.filter("row_id >= 590")]
    for k, p in enumerate(parts):
        assert store.absorb(p, f"day{k}")
        upto = parts[0]
        for x in parts[1:k + 1]:
            upto = upto.unionByName(x)
        # another reader of the same folder sees the merged counts
        same(CountStore(spark, str(tmp_path / "s"), STATS, 8).counts().toPandas(), whole(upto).toPandas())
    assert not store.absorb(parts[1], "day1")
    same(store.counts().toPandas(), whole(df).toPandas())
    got = {r.row_id: r.nunique for r in store.attach(df, STATS[0], "n_distinct", "nunique").collect()}
    assert len(got) == df.count() and max(got.values()) == 6


def test_a_merge_reads_only_touched_buckets(spark, tmp_path):
    _, df = log(spark)
    store = CountStore(spark, str(tmp_path / "s"), STATS[:1], buckets=64)
    store.absorb(df, "a")
    before = store.manifest()[0]
    store.absorb(df.filter("uid = 1"), "b")
    after = store.manifest()[0]
    assert sum(after[b] != before[b] for b in before) == 1 and store.version() == 2
    # a merge that failed before its manifest leaves the last version in force
    spark.range(3).write.parquet(str(tmp_path / "s" / "data" / "v=3"))
    assert store.version() == 2 and store.counts().count() > 0


# --- search --------------------------------------------------------------------

SPACE = {"a": list(range(10)), "b": list(range(10)), "c": ["x", "y"]}


def surface(p):
    return -((p["a"] - 7) ** 2) - (p["b"] - 2) ** 2 + (3 if p["c"] == "y" else 0)


def test_densities_and_split():
    history = [({"a": k % 3, "b": 0, "c": "x"}, float(k)) for k in range(10)]
    good, rest = TS.split_trials(history)
    assert [p["a"] for p in good] == [0] and len(rest) == 9  # ceil(0.25 sqrt(10)) = 1: the trial of metric 9
    d = TS.densities(rest, "a", [0, 1, 2, 3])
    assert sum(d) == pytest.approx(1) and d == pytest.approx([(3 + 0.25) / 10] * 3 + [0.025])
    p = {"a": 0, "b": 0, "c": "x"}
    want = sum(math.log(TS.densities(good, k, v)[v.index(p[k])] / TS.densities(rest, k, v)[v.index(p[k])]) for k, v in SPACE.items())
    assert TS.gain(p, good, rest, SPACE) == pytest.approx(want)


def test_proposals_beat_random_draws():
    found, drawn = [], []
    for seed in range(30):
        trials = TS.run(surface, SPACE, 40, parallel=4, startup=8, seed=seed)
        assert len(trials) == 40 and len({tuple(p.items()) for p, _ in trials}) == 40
        found.append(max(m for _, m in trials))
        r = random.Random(seed)
        drawn.append(max(surface({k: r.choice(v) for k, v in SPACE.items()}) for _ in range(40)))
    assert np.mean(found) > np.mean(drawn) + 0.5
    assert TS.run(surface, SPACE, 12, parallel=3, seed=1) == TS.run(surface, SPACE, 12, parallel=3, seed=1)
    small = {"a": [1, 2], "c": ["x"]}
    assert len({tuple(p.items()) for p in TS.propose([], small, 2, startup=0)}) == 2

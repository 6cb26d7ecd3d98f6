"""Leaf-wise boosting against a numpy search over the same cuts."""

import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcraft.operators import leafwise as LW
from fieldcraft.operators import models as ML
from fieldcraft.operators import sparse
from fieldcraft.operators.encode import FieldSpec
from fieldcraft.operators.evaluate import exact_auc

SPECS = [FieldSpec("x", "continuous"), FieldSpec("z", "continuous"), FieldSpec("cat"), FieldSpec("kw", "multi")]


def data(n, seed=5):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x, z, c = round(float(r.normal()), 2), float(r.integers(-3, 4)), int(r.integers(0, 5))
        kw = " ".join(f"t{t}" for t in r.integers(0, 6, r.integers(0, 4)))
        p = 1 / (1 + math.exp(-(2.5 * (x > 0.3) * (z < 1) - 2 * (c == 2) + 1.5 * ("t1" in kw) * (x < 0) - 0.5)))
        out.append((i, x, z, f"c{c}", kw, int(r.random() < p), i % 4 == 0))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "row_id long, x double, z double, cat string, kw string, label int, is_valid boolean")


def encoded(spark, df, n_blocks):
    vocab = sparse.fit_vocabulary(df, SPECS, min_df=2)
    return sparse.encode_blocks(df, SPECS, vocab, n_blocks).cache()


def dense(blocks):
    rows = sorted(sparse.block_rows(blocks).collect(), key=lambda r: r.row_id)
    m = np.zeros((len(rows), 1 + max(max(r.indices, default=0) for r in rows)))
    for i, r in enumerate(rows):
        m[i, r.indices] = r.vals
    return m


def best(m, cuts, g, h, rows, cfg):
    """The largest gain over all features and cuts of a set of rows."""
    out = (0.0, None, None)
    total = lambda mask: g[mask].sum() ** 2 / (h[mask].sum() + cfg.reg_lambda)
    for f, cs in cuts.items():
        for c in cs:
            left, right = rows & (m[:, f] <= c), rows & (m[:, f] > c)
            if min(left.sum(), right.sum()) < max(cfg.min_rows, 1) or \
                    min(h[left].sum(), h[right].sum()) < cfg.min_child_weight:
                continue
            gain = total(left) + total(right) - total(rows)
            if gain > out[0] + 1e-9:
                out = (gain, f, c)
    return out


def brute_gains(m, cuts, g, h, cfg):
    every = np.ones(len(m), bool)
    first = best(m, cuts, g, h, every, cfg)
    heap, gains, n = [(-first[0], 0, every, first)], [], 1
    while heap and len(gains) < cfg.leaves - 1:
        _, _, rows, (gain, f, c) = heapq.heappop(heap)
        if gain <= 0:
            break
        gains.append(gain)
        for side in (rows & (m[:, f] <= c), rows & (m[:, f] > c)):
            b = best(m, cuts, g, h, side, cfg)
            heapq.heappush(heap, (-b[0], n, side, b))
            n += 1
    return gains


@pytest.mark.parametrize("n_blocks", [1, 6])
def test_first_tree_equals_a_numpy_search(spark, n_blocks):
    df = table(spark, data(500))
    cfg = LW.BoostConfig(trees=1, leaves=9, lr=0.1, row_share=1.0, col_share=1.0, min_child_weight=2.0, min_rows=5,
                         max_bins=20)
    blocks = encoded(spark, df, n_blocks)
    cuts = LW.quantile_cuts(blocks, cfg.max_bins)
    by = {r.feature: list(r.cuts) for r in cuts.collect()}
    assert all(0.0 in c and c == sorted(c) and len(c) <= cfg.max_bins for c in by.values())
    model = LW.fit(blocks, df, cfg, valid=None)
    m = dense(blocks)
    y = np.array([r.label for r in df.orderBy("row_id").collect()])
    p = y.mean()
    assert model.base == pytest.approx(math.log(p / (1 - p)))
    g, h = p - y, np.full(len(y), p * (1 - p))
    tree, gains = model.trees[0], []
    rows = {0: np.ones(len(y), bool)}
    for i, node in enumerate(tree):
        mask = rows[i]
        if node.left < 0:
            assert node.value == pytest.approx(-0.1 * g[mask].sum() / (h[mask].sum() + 1))
            continue
        left, right = mask & (m[:, node.feature] <= node.cut), mask & (m[:, node.feature] > node.cut)
        rows[node.left], rows[node.right] = left, right
        part = lambda q: g[q].sum() ** 2 / (h[q].sum() + 1)
        gains.append(part(left) + part(right) - part(mask))
        # no other split of these rows gains more
        assert gains[-1] == pytest.approx(best(m, by, g, h, mask, cfg)[0], abs=1e-9)
    # and the same leaves are split, best first
    assert sorted(gains) == pytest.approx(sorted(brute_gains(m, by, g, h, cfg)), abs=1e-9)
    assert len(tree) == 2 * cfg.leaves - 1
    scores = {r.row_id: r.score for r in model.score(blocks).collect()}
    for i, node in enumerate(tree):
        for r in np.flatnonzero(rows[i]) if node.left < 0 else []:
            assert scores[int(r)] == pytest.approx(1 / (1 + math.exp(-model.base - node.value)))


def test_boosting_beats_depth_wise_trees_and_persists(spark, tmp_path):
    df = table(spark, data(2000, 9))
    cfg = LW.BoostConfig(trees=6, leaves=10, lr=0.3, min_child_weight=2.0, min_rows=5, stop_rounds=4, max_bins=32,
                         persist_every=3)
    blocks = encoded(spark, df, 3)
    model = LW.fit(blocks, df, cfg)
    assert len(model.trees) == 1 + int(np.argmax(model.history))  # up to the best on the validation rows
    scored = model.score(blocks).join(df.select("row_id", "label", "is_valid"), "row_id").filter("is_valid")
    auc = exact_auc(scored).first().auc
    assert auc == pytest.approx(max(model.history), abs=1e-9)
    width = dense(blocks).shape[1]
    rows = sparse.block_vectors(blocks, width).join(df.select("row_id", "label", "is_valid"), "row_id")
    clf = ML.gbt(max_iter=6, step=0.3, min_instances=5, max_depth=4)
    other = ML.fit_score(rows.filter("NOT is_valid"), rows.filter("is_valid"), clf, ["label"])[1]
    assert auc >= exact_auc(other).first().auc - 0.005 and auc > 0.7
    model.save(spark, str(tmp_path / "m"))
    again = LW.LeafwiseModel.load(spark, str(tmp_path / "m"))
    assert again.trees == model.trees and again.config == cfg and again.base == pytest.approx(model.base)


def test_sampling_is_repeatable_and_even():
    ids = np.arange(20_000)
    u = LW.uniform(ids, 7)
    assert (u == LW.uniform(ids, 7)).all() and 0 <= u.min() and u.max() < 1
    assert abs((u < 0.7).mean() - 0.7) < 0.02 and abs(((u < 0.7) & (LW.uniform(ids, 8) < 0.7)).mean() - 0.49) < 0.02


def test_rows_without_entries_and_one_class(spark):
    df = table(spark, [(i, 0.0, 0.0, None, None, 0, False) for i in range(30)])
    vocab = sparse.fit_vocabulary(df, SPECS)
    blocks = sparse.encode_blocks(df, SPECS, vocab, 2)
    model = LW.fit(blocks, df, LW.BoostConfig(trees=3, row_share=1.0, col_share=1.0))
    assert model.trees == []
    got = [r.score for r in model.score(blocks).collect()]
    assert len(got) == 30 and max(got) < 1e-5


def test_split_order_replays_best_gain_first():
    s = lambda gain: (None, (gain, 0, 0, 0, 0, 0) if gain else None)
    splits, children = {0: s(5.0)}, {}
    assert LW.split_order(splits, children, 4) == ([], [0])
    children[0] = (1, 2)
    splits |= {1: s(1.0), 2: s(3.0)}
    assert LW.split_order(splits, children, 4) == ([0], [2, 1])
    children |= {2: (3, 4), 1: (5, 6)}
    splits |= {3: s(2.0), 4: s(0.0), 5: s(9.0), 6: s(0.0)}
    assert LW.split_order(splits, children, 4) == ([0, 2], [3])
    children[3] = (7, 8)
    splits |= {7: s(0.0), 8: s(0.0)}
    assert LW.split_order(splits, children, 4) == ([0, 2, 3], [])
    assert LW.split_order(splits, children, 5) == ([0, 2, 3, 1], [])


def test_registered_query_trains_with_the_reference_parameters():
    from fieldcraft.plans.q_trained import BOOST
    assert (BOOST.trees, BOOST.stop_rounds, BOOST.leaves, BOOST.lr) == (300, 100, 31, 0.05)
    assert (BOOST.row_share, BOOST.col_share, BOOST.min_child_weight, BOOST.reg_lambda) == (0.7, 0.7, 50.0, 1.0)
    assert BOOST.max_bins == LW.BoostConfig().max_bins == 255


def test_a_round_is_one_job_and_trees_keep_to_the_rules(spark):
    df = table(spark, data(1500, 3))
    blocks = encoded(spark, df, 4)
    blocks.count()
    cfg = LW.BoostConfig(trees=8, leaves=15, lr=0.3, min_child_weight=1.0, min_rows=5, max_bins=32, persist_every=3)
    spark.sparkContext.setJobGroup("leafwise-rounds", "")
    model = LW.fit(blocks, df, cfg)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("leafwise-rounds"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 8 * (cfg.leaves - 1) + 60
    assert len(model.history) == 8 and all(len(t) <= 29 for t in model.trees)
    m, ids = dense(blocks), [r.row_id for r in df.select("row_id").orderBy("row_id").collect()]
    rows = {r.row_id: r for r in df.collect()}
    y, held = np.array([rows[i].label for i in ids]), np.array([rows[i].is_valid for i in ids])
    margin = np.full(len(ids), model.base)
    for number, tree in enumerate(model.trees):
        p = 1 / (1 + np.exp(-margin))
        live = ~held & (LW.uniform(np.array(ids), cfg.seed + number) < cfg.row_share)
        at = np.zeros(len(ids), int)
        for i, node in enumerate(tree):
            if node.left >= 0:
                assert LW.uniform(np.array([node.feature]), cfg.seed + 7919 * (number + 1))[0] < cfg.col_share
                at[at == i] = np.where(m[at == i, node.feature] <= node.cut, node.left, node.right)
            else:
                mine = live & (at == i)
                want = -cfg.lr * (p - y)[mine].sum() / ((p * (1 - p))[mine].sum() + cfg.reg_lambda)
                assert node.value == pytest.approx(want, abs=1e-9)
        margin += np.array([n.value for n in tree])[at]
        pos, neg = margin[held & (y > 0)], margin[held & (y == 0)]
        auc = np.mean((pos[:, None] > neg) + 0.5 * np.isclose(pos[:, None], neg, rtol=0, atol=1e-12))
        assert model.history[number] == pytest.approx(auc, abs=1e-9)


def test_slices_of_cells_grow_the_same_trees(spark, monkeypatch):
    df = table(spark, data(1200, 11))
    blocks = encoded(spark, df, 3)
    cfg = LW.BoostConfig(trees=2, leaves=12, lr=0.2, min_child_weight=1.0, min_rows=5, max_bins=32)
    one = LW.fit(blocks, df, cfg)
    monkeypatch.setattr(LW, "SLICE_CELLS", 20)
    monkeypatch.setattr(LW, "MOVE_EVERY", 2)
    many = LW.fit(blocks, df, cfg)
    assert one.history == pytest.approx(many.history, abs=1e-12)
    for a, b in zip(one.trees, many.trees):
        assert [(n.feature, n.bin, n.cut, n.left, n.right) for n in a] == [(n.feature, n.bin, n.cut, n.left, n.right) for n in b]
        assert [n.value for n in a] == pytest.approx([n.value for n in b], abs=1e-12)


def test_one_class_in_the_validation_rows_has_no_auc(spark):
    df = table(spark, [(*r[:5], 1 if r[6] else r[5], r[6]) for r in data(300, 2)])
    model = LW.fit(encoded(spark, df, 2), df, LW.BoostConfig(trees=5, stop_rounds=3, min_child_weight=1.0, persist_every=2))
    assert model.history == (None, None, None) and model.trees == []

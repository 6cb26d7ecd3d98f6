"""Leaf-wise gradient boosting for binary labels, trained on Spark.

Features come as CSR blocks (``operators.sparse``). Each feature gets quantile cuts
of its values (zero, the value of an absent entry, is always one); rows are stored
once as binned blocks, by column. A tree grows best gain first up to ``leaves``
leaves: the histogram of an open leaf (sums of gradients, of second derivatives and
rows per feature and bin) decides its best split, and the leaf of the largest gain
is split next, whatever its depth.

Training and validation rows are kept as shares (``Share``: the arrays of a few
blocks, by column, at most ``SHARE_ROWS`` rows), cached by Spark. A tree first picks
its sampled rows and columns out of each share; one round, a single small job, serves
all leaves that may still be split: tasks add up the histograms of the smaller child
of each such leaf, the larger child's is its parent's minus that, and the leaves' best
splits are searched on the sums of a few thousand cells. The order of splits is then
replayed; a leaf whose children were made but that is not reached stays a leaf. So a
tree takes about as many rounds as it is deep, not one per split, and equals the tree
grown one split at a time. Where the features have more than ``SLICE_CELLS`` cells,
slices of them are added up and searched by tasks of their own for both children, and
the driver only sees one split per leaf and slice.

Rows and columns are sampled per tree by a hash of their ids. Every ``persist_every``
trees the exact AUC on the validation rows after each of them is taken: distinct
margins are dealt to ranges and a range's pairs are counted in one task. Training stops
when ``stop_rounds`` trees bring no improvement and the trees up to the best are kept.
Margins are then written back to the shares; in between, tasks add the newest trees
themselves.

Cases: rows without entries have all features zero; a feature with one value gives
no split; without validation rows all trees are kept; labels above zero are
positive; equal gains take the smaller feature, then the smaller cut.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldcraft.operators.sparse import BLOCK_ROWS
from fieldcraft.session import drop_folder, drop_scratch, materialize

BINNED = ("block long, row_ids array<long>, labels array<double>, held array<boolean>, margins array<double>, "
          "feat_ids array<long>, zeros array<int>, widths array<int>, colptr array<long>, rows array<int>, bins array<int>")
HIST = "leaf int, feature long, bin int, zero int, g double, h double, n long"
#: the feature number of a leaf's totals
TOTAL = -1
#: blocks that a reader holds at once
GROUP_ROWS = 2


@dataclass(frozen=True)
class BoostConfig:
    """Training parameters. ``min_child_weight``: least sum of second derivatives
    in a leaf; ``row_share`` / ``col_share``: sampled per tree."""
    trees: int = 300
    leaves: int = 31
    lr: float = 0.05
    row_share: float = 0.7
    col_share: float = 0.7
    min_child_weight: float = 50.0
    min_rows: int = 20
    reg_lambda: float = 1.0
    stop_rounds: int = 100
    max_bins: int = 255
    persist_every: int = 10
    seed: int = 2018


@dataclass
class Node:
    """A leaf, or once split the rule ``feature <= cut`` (bin <= ``bin``)."""
    value: float = 0.0
    feature: int = TOTAL
    bin: int = 0
    cut: float = 0.0
    left: int = -1
    right: int = -1


Tree = list[Node]


# ------------------------------------------------------------------ cuts and bins
def quantile_cuts(blocks: DataFrame, max_bins: int) -> DataFrame:
    """``feature, cuts, zero``: ascending cuts of each feature (value <= cut falls
    into the cut's bin), zero always among them, and the bin of zero."""
    from fieldcraft.operators.sparse import block_rows
    probs = [(i + 1) / (max_bins - 1) for i in range(max_bins - 1)]
    vals = block_rows(blocks).select(F.inline(F.arrays_zip("indices", "vals"))).toDF("feature", "val")
    q = vals.groupBy("feature").agg(F.percentile_approx("val", F.array(*[F.lit(p) for p in probs]),
                                                        F.lit(max(10_000, 100 * max_bins))).alias("q"))
    cuts = F.array_sort(F.array_distinct(F.concat("q", F.array(F.lit(0.0)))))
    return q.select("feature", cuts.alias("cuts")).withColumn(
        "zero", (F.array_position("cuts", 0.0) - 1).cast("int"))


def bin_blocks(blocks: DataFrame, rows: DataFrame, cuts: DataFrame, base: float, row_id: str = "row_id",
               label: str = "label", valid: str | None = None) -> DataFrame:
    """Binned blocks by column: CSR ``blocks`` meet the cuts of their features and
    the labels of their rows, block by block."""
    links = blocks.select("block", F.explode(F.array_distinct("indices")).alias("feature")).join(cuts, "feature")
    own = blocks.select("block", F.explode("row_ids").alias("row_id"))
    held = F.coalesce(F.col(valid), F.lit(False)) if valid else F.lit(False)
    ys = own.join(rows.select(F.col(row_id).alias("row_id"), (F.col(label) > 0).cast("double").alias("label"),
                              held.alias("held")), "row_id")
    side = (links.withColumn("row_id", F.lit(None).cast("long")).withColumn("label", F.lit(None).cast("double"))
            .withColumn("held", F.lit(None).cast("boolean"))
            .unionByName(ys, allowMissingColumns=True).withColumnRenamed("block", "at"))
    side = side.select(F.col("at").alias("at"), *[c for c in side.columns if c != "at"])

    def build(left, right):
        import pyarrow as pa
        import pyarrow.compute as pc
        names = [f.split()[0] for f in BINNED.split(", ")]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_()), pa.list_(pa.float64()),
                 pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()),
                 pa.list_(pa.int32()), pa.list_(pa.int32())]
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in types], names)
        ids, indptr, idx, val = (np.asarray(left.column(c).combine_chunks().values)
                                 for c in ("row_ids", "indptr", "indices", "vals"))
        is_row = right.column("row_id").is_valid()
        known = right.filter(is_row)
        at = np.searchsorted(ids, np.asarray(known.column("row_id")))
        y, out = np.full(len(ids), np.nan), np.zeros(len(ids), bool)
        y[at], out[at] = np.asarray(known.column("label")), np.asarray(known.column("held"))
        spec = right.filter(pc.invert(is_row)).combine_chunks()
        feat = np.asarray(spec.column("feature"))
        order = np.argsort(feat)
        feat, lists = feat[order], spec.column("cuts").to_pylist()
        lists = [np.array(lists[i]) for i in order.tolist()]
        zeros = np.asarray(spec.column("zero"))[order]
        col = np.searchsorted(feat, idx)
        row = np.repeat(np.arange(len(ids)), np.diff(indptr))
        by = np.argsort(col, kind="stable")
        col, row, val = col[by], row[by], val[by]
        ptr = np.searchsorted(col, np.arange(len(feat) + 1))
        bins = np.concatenate([np.searchsorted(c, val[a:b], "left") for c, a, b in zip(lists, ptr[:-1], ptr[1:])]
                              or [np.empty(0, np.int64)])
        some = bins != zeros[col] if len(col) else np.zeros(0, bool)
        ptr = np.searchsorted(col[some], np.arange(len(feat) + 1))
        cols = [[int(left.column("block")[0].as_py())], [ids], [y], [out], [np.full(len(ids), base)], [feat], [zeros],
                [np.array([len(c) + 1 for c in lists], np.int64)], [ptr], [row[some]], [bins[some]]]
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names)

    return blocks.groupBy("block").cogroup(side.groupBy("at")).applyInArrow(build, BINNED)


# ------------------------------------------------------------------ array code of a block
Column = Callable[[int], tuple[np.ndarray, np.ndarray]]


def route(at: np.ndarray, tree: Tree, split: Sequence[int], column: Column, limit: str = "bin") -> np.ndarray:
    """The node of each row after the nodes ``split`` hand their rows to their
    children. A node's rows go where an absent entry goes, those with an entry of its
    feature are put right; ``column``: rows and values of a feature's entries."""
    to = np.arange(len(tree), dtype=at.dtype)
    left, right, most = to.copy(), to.copy(), np.zeros(len(tree))
    by = defaultdict(list)
    for i in split:
        node = tree[i]
        left[i], right[i], most[i] = node.left, node.right, getattr(node, limit)
        to[i] = node.left if node.cut >= 0.0 else node.right
        by[node.feature].append(i)
    out = to[at]
    for feature, nodes in by.items():
        rows, x = column(feature)
        here = np.zeros(len(tree), bool)
        here[nodes] = True
        was = at[rows]
        e = np.flatnonzero(here[was])
        was = was[e]
        out[rows[e]] = np.where(x[e] <= most[was], left[was], right[was])
    return out


def leaves_of(rows: int, tree: Tree, column: Column, limit: str = "bin") -> np.ndarray:
    """The leaf that each row ends in."""
    return descend(np.zeros(rows, np.int32), tree, [0], column, limit)


def descend(at: np.ndarray, tree: Tree, nodes: Sequence[int], column: Column, limit: str = "bin") -> np.ndarray:
    """The leaf that each row ends in from one of the ``nodes``."""
    while nodes := [i for i in nodes if tree[i].left >= 0]:
        at = route(at, tree, nodes, column, limit)
        nodes = [c for i in nodes for c in (tree[i].left, tree[i].right)]
    return at


class Block:
    """One binned block as arrays."""

    def __init__(self, batch, b: int) -> None:
        self.ids, self.y, self.held, self.margins, self.feat, self.zeros, self.widths, self.ptr, self.rows, self.bins = (
            np.asarray(batch.column(f.split()[0])[b].values.to_numpy(zero_copy_only=False))
            for f in BINNED.split(", ")[1:])
        self.offset = np.concatenate(([0], np.cumsum(self.widths)))

    def column(self, feature: int) -> tuple[np.ndarray, np.ndarray]:
        c = int(np.searchsorted(self.feat, feature))
        if c == len(self.feat) or self.feat[c] != feature:
            return self.rows[:0], self.bins[:0]
        return self.rows[self.ptr[c]:self.ptr[c + 1]], self.bins[self.ptr[c]:self.ptr[c + 1]]

    def leaf_of(self, tree: Tree) -> np.ndarray:
        """The node that each row ends in."""
        return leaves_of(len(self.ids), tree, self.column)

    def margin(self, trees: Sequence[Tree]) -> np.ndarray:
        out = self.margins
        for t in trees:
            out = out + np.array([n.value for n in t])[self.leaf_of(t)]
        return out

    def histogram(self, at: np.ndarray, ask: list[int], g: np.ndarray, h: np.ndarray, live: np.ndarray,
                  cols: np.ndarray) -> list[np.ndarray]:
        """Sums per (leaf of ``ask``, feature, bin) over the ``live`` rows and the
        columns ``cols``, and the leaves' totals."""
        slot = np.full(max(int(at.max(initial=0)), *ask) + 1, -1)
        slot[ask] = np.arange(len(ask))
        s = np.where(live, slot[at], -1)
        mine = np.flatnonzero(s >= 0)
        totals = [np.bincount(s[mine], v[mine], len(ask)) for v in (g, h, np.ones(len(g)))]
        col = np.repeat(np.arange(len(self.feat)), np.diff(self.ptr))
        e = np.flatnonzero((s[self.rows] >= 0) & cols[col]) if len(col) else np.empty(0, np.int64)
        width = int(self.offset[-1])
        row = self.rows[e]
        key = s[row] * width + self.offset[col[e]] + self.bins[e]
        n = np.bincount(key)
        full = np.flatnonzero(n)
        leaf, rest = np.divmod(full, max(width, 1))
        c = np.searchsorted(self.offset, rest, "right") - 1
        ask_ = np.array(ask)
        none = np.zeros(len(ask), np.int64)
        return [np.concatenate(p) for p in (
            (ask_[leaf], ask_), (self.feat[c], none + TOTAL), (rest - self.offset[c], none), (self.zeros[c], none),
            (np.bincount(key, g[row], len(n))[full], totals[0]), (np.bincount(key, h[row], len(n))[full], totals[1]),
            (n[full], totals[2].astype(np.int64)))]


def uniform(ids: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) from ids, by a 64-bit mix."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64(salt % (1 << 63)) * np.uint64(0x9E3779B97F4A7C15)
        for mult, shift in ((0xBF58476D1CE4E5B9, 30), (0x94D049BB133111EB, 27)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(mult)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _sigmoid(m: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * m))


# ------------------------------------------------------------------ a tree
def leaf_histograms(binned: DataFrame, newest: Sequence[Tree], tree: Tree, ask: list[int], number: int,
                    cfg: BoostConfig) -> DataFrame:
    """Histograms of the leaves ``ask`` of a growing tree as a table, in one aggregation."""
    def run(batches):
        import pyarrow as pa
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]
        names = [f.split()[0] for f in HIST.split(", ")]
        for batch in batches:
            for b in range(batch.num_rows):
                block = Block(batch, b)
                p = _sigmoid(block.margin(newest))
                live = ~block.held & (uniform(block.ids, cfg.seed + number) < cfg.row_share)
                cols = uniform(block.feat, cfg.seed + 7919 * (number + 1)) < cfg.col_share
                got = block.histogram(block.leaf_of(tree), ask, p - block.y, p * (1 - p), live, cols)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(got, types)], names)

    return (binned.mapInArrow(run, HIST).groupBy("leaf", "feature", "bin")
            .agg(F.max("zero").alias("zero"), F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")))


def best_splits(hist: DataFrame, cfg: BoostConfig) -> dict[int, tuple]:
    """Per leaf ``(totals, best split or None)``; totals are (g, h, n), a split is
    (gain, feature, bin, left sums). One row per leaf reaches the driver."""
    totals = hist.filter(F.col("feature") == TOTAL).select("leaf", F.col("g").alias("all_g"), F.col("h").alias("all_h"),
                                                           F.col("n").alias("all_n"))
    per = hist.filter(F.col("feature") != TOTAL)
    every = F.broadcast(totals)  # one row per open leaf
    zero = (per.groupBy("leaf", "feature").agg(F.max("zero").alias("bin"), F.sum("g").alias("g"),
                                               F.sum("h").alias("h"), F.sum("n").alias("n"))
            .join(every, "leaf").select("leaf", "feature", "bin", (F.col("all_g") - F.col("g")).alias("g"),
                                        (F.col("all_h") - F.col("h")).alias("h"), (F.col("all_n") - F.col("n")).alias("n")))
    # at most max_bins + 1 rows of a feature
    w = Window.partitionBy("leaf", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    run = (per.select("leaf", "feature", "bin", "g", "h", "n").unionByName(zero)
           .select("leaf", "feature", "bin", *[F.sum(c).over(w).alias(c) for c in ("g", "h", "n")]).join(every, "leaf"))
    part = lambda g, h: g * g / (h + cfg.reg_lambda)
    gain = (part(F.col("g"), F.col("h")) + part(F.col("all_g") - F.col("g"), F.col("all_h") - F.col("h"))
            - part(F.col("all_g"), F.col("all_h")))
    ok = ((F.col("h") >= cfg.min_child_weight) & (F.col("all_h") - F.col("h") >= cfg.min_child_weight)
          & (F.col("n") >= cfg.min_rows) & (F.col("all_n") - F.col("n") >= cfg.min_rows) & (F.col("n") < F.col("all_n")))
    best = (run.filter(ok).withColumn("gain", gain).filter("gain > 1e-12").groupBy("leaf")
            .agg(F.max_by(F.struct("gain", "feature", "bin", "g", "h", "n"),
                          F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("s")))
    out = {}
    for r in totals.join(best, "leaf", "left").collect():
        out[r["leaf"]] = ((r["all_g"], r["all_h"], r["all_n"]), tuple(r["s"]) if r["s"] else None)
    return out


def split_order(splits: dict[int, tuple], children: dict[int, tuple[int, int]], leaves: int) -> tuple[list[int], list[int]]:
    """Best gain first from node 0: the nodes split, as far as their children are
    known, and if that ends early the open nodes that may be split next, best first."""
    heap, done = [], []

    def push(i: int) -> None:
        if splits[i][1] is not None:
            heapq.heappush(heap, (-splits[i][1][0], i))

    push(0)
    while heap and len(done) < leaves - 1:
        _, i = heapq.heappop(heap)
        if i not in children:
            wanted = [i, *[j for _, j in sorted(heap) if j not in children]]
            return done, wanted[:leaves - 1 - len(done)]
        done.append(i)
        for c in children[i]:
            push(c)
    return done, []


def _cut_values(cuts: DataFrame, features: Iterable[int]) -> dict[int, list[float]]:
    """Cuts of the split features (at most one per leaf of a stage's trees)."""
    return {r["feature"]: r["cuts"] for r in cuts.filter(F.col("feature").isin(sorted(set(features)))).collect()}


def prune(tree: Tree, splits: dict[int, tuple], done: set[int], cfg: BoostConfig) -> Tree:
    """The nodes that the order of splits reached, with leaf values."""
    out: Tree = []

    def copy(i: int) -> int:
        at = len(out)
        (g, h, _), node = splits[i][0], tree[i]
        if i in done:
            out.append(Node(feature=node.feature, bin=node.bin, cut=node.cut))
            out[at].left = copy(node.left)
            out[at].right = copy(node.right)
        else:
            out.append(Node(value=-cfg.lr * g / (h + cfg.reg_lambda)))
        return at

    copy(0)
    return out


# ------------------------------------------------------------------ shares
#: most rows of a share; places of rows then take two bytes
SHARE_ROWS = 1 << 16
#: cells (feature, bin) whose sums are searched at a time
SLICE_CELLS = 1 << 15
#: rounds after which the rows' nodes are written to the samples
MOVE_EVERY = 5
#: sums that a task makes at a time
_SUMS = 1 << 22


def _narrow(a: np.ndarray, most: int) -> np.ndarray:
    return a.astype(np.min_scalar_type(max(most, 1)))


@dataclass
class Share:
    """Rows of some blocks as arrays. Entries are by column: ``rows`` and ``cells``
    (the column's ``offset`` + bin) between two of ``ptr``."""
    ids: np.ndarray
    y: np.ndarray
    margins: np.ndarray
    feat: np.ndarray
    zeros: np.ndarray
    offset: np.ndarray
    ptr: np.ndarray
    rows: np.ndarray
    cells: np.ndarray

    @staticmethod
    def of(blocks: Sequence[Block], held: bool) -> "Share":
        """The validation rows (``held``) or the training rows of the blocks."""
        feat, first = np.unique(np.concatenate([b.feat for b in blocks]), return_index=True)
        zeros, widths = (np.concatenate([getattr(b, c) for b in blocks])[first] for c in ("zeros", "widths"))
        offset = np.concatenate(([0], np.cumsum(widths)))
        ids, y, margins, cols, rows, cells, above = [], [], [], [], [], [], 0
        for b in blocks:
            mine = b.held == held
            col = np.repeat(np.searchsorted(feat, b.feat), np.diff(b.ptr))
            e = np.flatnonzero(mine[b.rows])
            cols.append(col[e])
            rows.append((np.cumsum(mine) - 1)[b.rows[e]] + above)
            cells.append(offset[col[e]] + b.bins[e])
            for out, a in ((ids, b.ids), (y, b.y), (margins, b.margins)):
                out.append(a[mine])
            above += int(mine.sum())
        cols = np.concatenate(cols)
        order = np.argsort(cols, kind="stable")
        return Share(np.concatenate(ids), np.concatenate(y), np.concatenate(margins), feat, zeros, offset,
                     np.searchsorted(cols[order], np.arange(len(feat) + 1)),
                     _narrow(np.concatenate(rows)[order], above), _narrow(np.concatenate(cells)[order], int(offset[-1])))

    def column(self, feature: int) -> tuple[np.ndarray, np.ndarray]:
        c = int(np.searchsorted(self.feat, feature))
        if c == len(self.feat) or self.feat[c] != feature:
            return self.rows[:0], self.cells[:0]
        return self.rows[self.ptr[c]:self.ptr[c + 1]], self.cells[self.ptr[c]:self.ptr[c + 1]].astype(np.int64) - self.offset[c]

    def after(self, trees: Sequence[Tree]) -> Iterable[np.ndarray]:
        """Margins after each of the trees."""
        m = self.margins
        for t in trees:
            m = m + np.array([n.value for n in t])[leaves_of(len(self.ids), t, self.column)]
            yield m

    def advanced(self, trees: Sequence[Tree]) -> "Share":
        return replace(self, margins=[self.margins, *self.after(trees)][-1])

    def sampled(self, trees: Sequence[Tree], number: int, cfg: BoostConfig) -> "Sample":
        """The rows and columns of tree ``number``."""
        live = uniform(self.ids, cfg.seed + number) < cfg.row_share
        cols = uniform(self.feat, cfg.seed + 7919 * (number + 1)) < cfg.col_share
        e = np.flatnonzero(np.repeat(cols, np.diff(self.ptr)) & live[self.rows])
        ptr = np.searchsorted(e, self.ptr)
        p = _sigmoid([self.margins, *self.after(trees)][-1][live])
        rows, cells = (np.cumsum(live) - 1)[self.rows[e]], self.cells[e]
        present = np.flatnonzero(np.bincount(cells, minlength=int(self.offset[-1])))
        col = np.searchsorted(self.offset, present, "right") - 1
        keys = (self.feat[col] << 32) | (self.zeros[col] << 16) | (present - self.offset[col])
        dense = np.zeros(int(self.offset[-1]) + 1, np.int64)
        dense[present] = np.arange(len(present))
        return Sample(p - self.y[live], p * (1 - p), np.zeros(len(p), np.uint8), self.feat, ptr, _narrow(rows, len(p)),
                      _narrow(dense[cells], len(present)), keys)

    def counts(self, margins: np.ndarray, edges: np.ndarray) -> Iterable[tuple[int, tuple]]:
        """``(range, (distinct margins, positives, negatives))`` of the rows; a margin
        is in the same range in every share."""
        values, at = np.unique(margins, return_inverse=True)
        pos = ~(self.y <= 0)
        p, n = (np.bincount(at[x], minlength=len(values)) for x in (pos, ~pos))
        cut = np.concatenate(([0], np.searchsorted(values, edges), [len(values)]))
        for i, (a, z) in enumerate(zip(cut[:-1], cut[1:])):
            if z > a:
                yield i, (values[a:z], *(_narrow(x[a:z], int(x[a:z].max())) for x in (p, n)))


def towards(tree: Tree, ask: Sequence[int]) -> Tree:
    """The tree without the splits that do not lead to a leaf of ``ask``."""
    on = set(ask)
    for i in range(len(tree) - 1, -1, -1):  # children come after their node
        if tree[i].left >= 0 and (tree[i].left in on or tree[i].right in on):
            on.add(i)
    return [n if i in on else Node() for i, n in enumerate(tree)]


@dataclass
class Sample:
    """The sampled rows of a share with their gradients and nodes, and their entries in
    the sampled columns by place in ``keys`` (feature, zero bin and bin of a cell)."""
    g: np.ndarray
    h: np.ndarray
    at: np.ndarray
    feat: np.ndarray
    ptr: np.ndarray
    rows: np.ndarray
    cells: np.ndarray
    keys: np.ndarray

    def column(self, feature: int) -> tuple[np.ndarray, np.ndarray]:
        c = int(np.searchsorted(self.feat, feature))
        if c == len(self.feat) or self.feat[c] != feature:
            return self.rows[:0], self.cells[:0]
        a, z = self.ptr[c], self.ptr[c + 1]
        return self.rows[a:z], self.keys[self.cells[a:z]] & 0xFFFF

    def moved(self, tree: Tree, nodes: Sequence[int]) -> "Sample":
        """With the rows of the ``nodes`` in their leaves."""
        return replace(self, at=_narrow(descend(self.at.astype(np.int32), tree, nodes, self.column), len(tree)))

    def sums(self, tree: Tree, nodes: Sequence[int], ask: Sequence[int]) -> np.ndarray:
        """``[g h n, leaf of ask, totals and keys]``; rows are in one of the ``nodes``."""
        at, width = descend(self.at.astype(np.int32), towards(tree, ask), nodes, self.column), len(self.keys)
        out = np.zeros((3, len(ask), 1 + width))
        step = max(1, _SUMS // max(width, 1))
        for a in range(0, len(ask), step):
            some = ask[a:a + step]
            slot = np.full(len(tree), -1, np.int32)
            slot[some] = np.arange(len(some))
            s = slot[at]
            mine = np.flatnonzero(s >= 0)
            of = s[self.rows]
            e = np.flatnonzero(of >= 0)
            key, row = of[e] * np.int64(width) + self.cells[e], self.rows[e]
            for i, v in enumerate((self.g, self.h, None)):
                out[i, a:a + step, 0] = np.bincount(s[mine], v if v is None else v[mine], len(some))
                out[i, a:a + step, 1:] = np.bincount(key, v if v is None else v[row], len(some) * width).reshape(len(some), width)
        return out


def _shares(binned: DataFrame, held: bool, parts: int) -> RDD:
    """The shares of the validation rows (``held``) or of the training rows, cached."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        def made(blocks, n):
            share = Share.of(blocks, held)
            number = (TaskContext.get().partitionId() << 32) + n
            return pa.record_batch([pa.array([number], pa.int64()), pa.array([pickle.dumps(share, 5)], pa.binary())],
                                   ["number", "share"])

        some, n, number = [], 0, 0
        for batch in batches:
            for b in range(batch.num_rows):
                block = Block(batch, b)
                more = int((block.held == held).sum())
                if some and n + more > SHARE_ROWS:
                    yield made(some, number)
                    some, n, number = [], 0, number + 1
                if more:
                    some.append(block)
                    n += more
        if some:
            yield made(some, number)

    table = binned.repartitionByRange(parts, "block").mapInArrow(run, "number long, share binary")
    return table.rdd.map(lambda r: pickle.loads(r[1])).persist(StorageLevel.MEMORY_AND_DISK)


def _advance(shares: RDD, trees: Sequence[Tree]) -> RDD:
    """Shares with the newest trees in their margins, written anew."""
    out = shares.map(lambda s: s.advanced(trees)).persist(StorageLevel.MEMORY_AND_DISK)
    out.checkpoint()
    out.count()
    _forget(shares)
    return out


def _forget(shares: RDD) -> None:
    shares.unpersist()
    if shares.getCheckpointFile():
        drop_folder(SparkSession.active(), shares.getCheckpointFile())


# ------------------------------------------------------------------ splits of summed cells
def merge(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and sums added up; the first key, -1, holds the leaves' totals."""
    if len(parts) == 1:
        return parts[0]
    keys = np.unique(np.concatenate([k for k, _ in parts]))
    out = np.zeros((*parts[0][1].shape[:2], len(keys)))
    for k, sums in parts:
        out[:, :, np.searchsorted(keys, k)] += sums
    return keys, out


class Cells:
    """Cells (feature, bin) ascending, the bin of zero always among them."""

    def __init__(self, keys: np.ndarray) -> None:
        self.given = keys[keys >= 0]
        self.keys = np.union1d(self.given, (self.given >> 16 << 16) | ((self.given >> 16) & 0xFFFF))
        self.feature, self.zero, self.bin = self.keys >> 32, (self.keys >> 16) & 0xFFFF, self.keys & 0xFFFF
        self.start = np.flatnonzero(np.diff(self.feature, prepend=-1))
        self.zeros = np.flatnonzero(self.bin == self.zero)
        size = np.diff(self.start, append=len(self.keys))
        # features of about equal numbers of cells are summed up side by side
        kind = np.ceil(np.log2(np.maximum(size, 1))).astype(int)
        self.groups = []
        for k in np.unique(kind):
            mine, step = np.flatnonzero(kind == k), np.arange(1 << k)
            self.groups.append(np.where(step < size[mine][:, None], self.start[mine][:, None] + step, len(self.keys)))

    def aligned(self, keys: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """``[g h n, leaf, cells and totals]``; cells of zero bins are left empty."""
        out = np.zeros((*sums.shape[:2], len(self.keys) + 1))
        out[:, :, np.searchsorted(self.keys, keys[1:])] = sums[:, :, 1:]
        out[:, :, -1] = sums[:, :, 0]
        return out

    def best(self, sums: np.ndarray, cfg: BoostConfig) -> list[tuple]:
        """Per leaf ``(totals, best split or None)``; a split is as in ``best_splits``,
        and whether zero goes left."""
        step = max(1, _SUMS // sums.shape[2])
        return [one for a in range(0, sums.shape[1], step) for one in self._best(sums[:, a:a + step], cfg)]

    def _best(self, sums: np.ndarray, cfg: BoostConfig) -> list[tuple]:
        total = sums[:, :, -1]
        out: list = [None] * sums.shape[1]
        if len(self.keys):
            full = np.concatenate([sums[:, :, :-1], np.zeros((*sums.shape[:2], 1))], 2)
            rest = total[:, :, None] - np.add.reduceat(sums[:, :, :-1], self.start, 2)
            rest[:2] *= rest[2] > 0
            full[:, :, self.zeros] = rest
        all_g, all_h, all_n = (t[:, None, None] for t in total)
        part = lambda g, h: g * g / (h + cfg.reg_lambda)
        for group in self.groups:
            g, h, n = np.cumsum(full[:, :, group], 3)
            ok = ((h >= cfg.min_child_weight) & (all_h - h >= cfg.min_child_weight) & (n >= cfg.min_rows)
                  & (all_n - n >= cfg.min_rows) & (n < all_n))
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, part(g, h) + part(all_g - g, all_h - h) - part(all_g, all_h), -np.inf)
            gain = gain.reshape(len(out), -1)
            for i, at in enumerate(gain.argmax(1)):  # the first of equals: smaller feature, smaller cut
                if gain[i, at] > 1e-12:
                    cell = group.flat[at]
                    found = (float(gain[i, at]), int(self.feature[cell]), int(self.bin[cell]),
                             *(float(x[i].flat[at]) for x in (g, h, n)), bool(self.zero[cell] <= self.bin[cell]))
                    if out[i] is None or better(found, out[i]):
                        out[i] = found
        return [((float(t[0]), float(t[1]), int(t[2])), split) for t, split in zip(total.T, out)]


def better(one: tuple, other: tuple) -> bool:
    """Larger gain, then smaller feature, then smaller cut."""
    return (one[0], -one[1], -one[2]) > (other[0], -other[1], -other[2])


def _summed(samples: RDD, tree: Tree, nodes: Sequence[int], ask: Sequence[int], slices: int) -> RDD:
    """``slice, (keys, sums)`` of each task."""
    def run(part):
        got = [(np.append(-1, s.keys), s.sums(tree, nodes, ask)) for s in part]
        if got:
            keys, sums = merge(got)
            for i in range(slices):
                mine = np.flatnonzero((keys < 0) | ((keys >> 32) % slices == i))
                yield i, (keys[mine], sums[:, :, mine])

    return samples.mapPartitions(run)


def _searched(summed: RDD, ask: Sequence[int], cfg: BoostConfig, slices: int) -> dict[int, tuple]:
    """Totals and best split of each leaf, the slices of cells added up by tasks."""
    def search(one):
        cells = Cells(one[0])
        return cells.best(cells.aligned(*one), cfg)

    out: dict[int, tuple] = {}
    parts = min(slices, summed.getNumPartitions())
    for found in summed.reduceByKey(lambda a, b: merge([a, b]), parts).values().map(search).collect():
        for leaf, (total, split) in zip(ask, found):
            old = out.get(leaf, (total, None))[1]
            out[leaf] = (total, split if old is None or (split is not None and better(split, old)) else old)
    return out


def _moved(samples: RDD, tree: Tree, nodes: Sequence[int]) -> RDD:
    """Samples whose rows are in the leaves made so far, cached."""
    return samples.map(lambda s: s.moved(tree, nodes)).persist(StorageLevel.MEMORY_AND_DISK)


def grow(shares: RDD, newest: Sequence[Tree], number: int, cfg: BoostConfig, slices: int = 1) -> Tree:
    """One tree, best gain first. ``newest``: trees not yet in the shares' margins. A
    split's ``cut`` only tells where zero goes."""
    samples = shares.map(lambda s: s.sampled(newest, number, cfg)).persist(StorageLevel.MEMORY_AND_DISK)
    tree, children, kept, cells = [Node()], {}, {}, None
    nodes, rounds = [0], 0
    root = _summed(samples, tree, nodes, [0], slices)
    if slices > 1:
        splits = _searched(root, [0], cfg, slices)
    else:
        got = [m for _, m in root.collect()]  # a few thousand cells a task
        splits = {}
        if got:
            keys, sums = merge(got)
            cells = Cells(keys)  # those of any leaf are among the root's
            kept[0] = cells.aligned(keys, sums)[:, 0]
            splits[0] = cells.best(kept[0][:, None], cfg)[0]
    if 0 not in splits or not splits[0][0][2]:  # no row was sampled
        samples.unpersist()
        return tree
    done, wanted = split_order(splits, children, cfg.leaves)
    while wanted:
        asked, pairs = [], []
        for i in wanted:
            _, feature, b, _, _, n, zero_left = splits[i][1]
            left, right = len(tree), len(tree) + 1
            tree += [Node(), Node()]
            tree[i] = Node(feature=feature, bin=b, cut=0.0 if zero_left else -1.0, left=left, right=right)
            children[i] = (left, right)
            small, large = (left, right) if 2 * n <= splits[i][0][2] else (right, left)
            asked += [small] if slices == 1 else [small, large]
            pairs.append((i, small, large))
        rounds, old = rounds + 1, None
        if rounds % MOVE_EVERY == 0:
            old, samples = samples, _moved(samples, list(tree), nodes)
            nodes = [i for i, n in enumerate(tree) if n.left < 0]
        summed = _summed(samples, tree, nodes, asked, slices)
        if slices > 1:
            splits.update(_searched(summed, asked, cfg, slices))
        else:
            low = cells.aligned(*merge([m for _, m in summed.collect()]))
            high = np.stack([kept.pop(i) for i, _, _ in pairs], 1) - low
            high[:2] *= high[2] > 0
            both, leaves = np.concatenate([low, high], 1), asked + [large for _, _, large in pairs]
            kept.update({leaf: both[:, at] for at, leaf in enumerate(leaves)})
            splits.update(zip(leaves, cells.best(both, cfg)))
        if old is not None:
            old.unpersist()
        done, wanted = split_order(splits, children, cfg.leaves)
    samples.unpersist()
    return prune(tree, splits, set(done), cfg)


def validation_aucs(shares: RDD, trees: Sequence[Tree]) -> list[float | None]:
    """The exact AUC (ties count half) of the shares' rows after each of the trees; null
    where one class is missing."""
    def picks(share):
        return np.stack([np.sort(m)[np.linspace(0, len(m) - 1, 16).astype(int)] for m in share.after(trees)])

    def pieces(share):
        for t, m in enumerate(share.after(trees)):
            for i, counts in share.counts(m, edges[t]):
                yield (t, i), counts

    def pairs(group):
        values, pos, neg = (np.concatenate(x) for x in zip(*group))
        same = np.unique(values, return_inverse=True)[1]
        p, n = np.bincount(same, pos), np.bincount(same, neg)
        return float(p.sum()), float(n.sum()), float((p * (np.cumsum(n) - 0.5 * n)).sum())

    parts = shares.getNumPartitions()
    seen = np.sort(np.concatenate(shares.map(picks).collect(), 1), 1)
    at = np.linspace(0, seen.shape[1] - 1, 2 * parts + 1).astype(int)[1:-1]
    edges = [np.unique(row[at]) for row in seen]
    won = [[0.0, 0.0, 0.0] for _ in trees]  # pairs won, positives, negatives below
    for (t, _), (p, n, inside) in sorted(shares.flatMap(pieces).groupByKey(parts).mapValues(pairs).collect()):
        w, pos, below = won[t]
        won[t] = [w + inside + p * below, pos + p, below + n]
    return [w / (p * n) if p * n else None for w, p, n in won]


# ------------------------------------------------------------------ model
NODES = ("tree int, node int, value double, feature long, bin int, cut double, left int, right int")


@dataclass
class LeafwiseModel:
    """Trees (a few dozen nodes each), starting margin, parameters and the
    validation AUC after each tree."""
    config: BoostConfig
    base: float
    trees: list[Tree]
    history: tuple = ()

    def score(self, blocks: DataFrame) -> DataFrame:
        """``row_id, score`` of CSR ``blocks``."""
        trees, base = self.trees, self.base

        def run(batches):
            import pyarrow as pa
            for batch in batches:
                for b in range(batch.num_rows):
                    ids, indptr, idx, val = (np.asarray(batch.column(c)[b].values)
                                             for c in ("row_ids", "indptr", "indices", "vals"))
                    row = np.repeat(np.arange(len(ids)), np.diff(indptr))
                    order = np.argsort(idx, kind="stable")
                    feat, row, val = idx[order], row[order], val[order]

                    def column(feature):
                        a, z = np.searchsorted(feat, [feature, feature + 1])
                        return row[a:z], val[a:z]

                    m = np.full(len(ids), base)
                    for t in trees:
                        m += np.array([n.value for n in t])[leaves_of(len(ids), t, column, "cut")]
                    yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(_sigmoid(m))], ["row_id", "score"])

        return blocks.select("row_ids", "indptr", "indices", "vals").mapInArrow(run, "row_id long, score double")

    def nodes(self, spark: SparkSession) -> DataFrame:
        rows = [(t, i, float(n.value), int(n.feature), int(n.bin), float(n.cut), n.left, n.right)
                for t, tree in enumerate(self.trees) for i, n in enumerate(tree)]
        return spark.createDataFrame(rows, NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([{**asdict(self.config), "base": self.base}]).write.mode("overwrite").parquet(f"{path}/config")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LeafwiseModel":
        c = spark.read.parquet(f"{path}/config").first().asDict()
        base = c.pop("base")
        trees: list[Tree] = []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            if r["node"] == 0:
                trees.append([])
            trees[-1].append(Node(r["value"], r["feature"], r["bin"], r["cut"], r["left"], r["right"]))
        return LeafwiseModel(BoostConfig(**c), base, trees)


def fit(blocks: DataFrame, rows: DataFrame, cfg: BoostConfig, row_id: str = "row_id", label: str = "label",
        valid: str | None = "is_valid") -> LeafwiseModel:
    """Train on CSR ``blocks`` and ``rows(row_id, label[, is_valid])``; rows flagged
    ``valid`` only decide when to stop. Blocks should hold the given rows only."""
    held = F.coalesce(F.col(valid), F.lit(False)) if valid else F.lit(False)
    share = rows.filter(~held).agg(F.avg((F.col(label) > 0).cast("double")), F.count("*")).first()
    checked = bool(valid) and not rows.filter(held).isEmpty()
    p = min(max(share[0] if share[0] is not None else 0.5, 1e-6), 1 - 1e-6)
    base = math.log(p / (1 - p))
    cuts = materialize(quantile_cuts(blocks, cfg.max_bins), "cuts")
    binned = materialize(bin_blocks(blocks, rows, cuts, base, row_id, label, valid), "binned", GROUP_ROWS)
    cells = cuts.agg(F.coalesce(F.sum(F.size("cuts") + 1), F.lit(0))).first()[0]
    slices = -(-max(cells, 1) // SLICE_CELLS)
    parts = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, -(-share[1] // BLOCK_ROWS)))
    train = _shares(binned, False, parts)
    check = _shares(binned, True, parts) if checked else None
    checked = check is not None and not check.isEmpty()
    trees, history, best, stopped = [], [], (None, 0), False
    while len(trees) < cfg.trees and not stopped:
        room = cfg.stop_rounds - (len(trees) - best[1]) if checked else cfg.trees
        newest: list[Tree] = []
        while len(newest) < min(cfg.trees - len(trees), cfg.persist_every, room):
            tree = grow(train, newest, len(trees) + len(newest), cfg, slices)
            if len(tree) == 1 and cfg.row_share >= 1 and cfg.col_share >= 1:
                stopped = True  # no split gains anything, nor will one later
                break
            newest.append(tree)
        values = _cut_values(cuts, {n.feature for t in newest for n in t if n.left >= 0})
        newest = [[replace(n, cut=values[n.feature][n.bin]) if n.left >= 0 else n for n in t] for t in newest]
        aucs = validation_aucs(check, newest) if checked and newest else []
        for auc in aucs:
            history.append(auc)
            if auc is not None and (best[0] is None or auc > best[0]):
                best = (auc, len(history))
        trees += newest
        stopped = stopped or (checked and len(trees) - best[1] >= cfg.stop_rounds)
        if len(trees) < cfg.trees and not stopped:
            train = _advance(train, newest)
            check = _advance(check, newest) if checked else None
    for shares in (train, check):
        if shares is not None:
            _forget(shares)
    drop_scratch(binned)
    kept = trees[:best[1]] if checked else trees
    return LeafwiseModel(cfg, base, kept, tuple(history))

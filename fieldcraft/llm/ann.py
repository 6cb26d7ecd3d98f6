"""Nearest neighbours by inner product with vantage-point trees per shard.

Largest inner product becomes nearest neighbour by one added coordinate:
x' = (x, sqrt(M^2 - |x|^2)) with M the largest norm, and a query gets 0 there, so
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x. Each shard builds a vantage-point tree over
its distinct vectors; a query skips a subtree when the triangle inequality puts
it farther than ``bound / factor``, where ``bound`` is the distance of its
current k-th neighbour. ``factor`` 1 is exact search; larger factors skip more.

Plan: vectors are dealt to shards of about ``shard_rows`` by a hash of the id; every
vector is shuffled once, to its shard, and every query once to each shard. Rows are
sorted by shard, vectors before queries, so a task reads a shard, builds its tree
once and then streams the queries through it, ``block_rows`` at a time: it holds one
shard and one block whatever the table's size. A window with a rank limit keeps k
rows of a query before the final shuffle.
Equal vectors share one tree entry with their smallest ids, so a vector held by
a third of all rows costs one entry per shard.

Scores are inner products in double precision of the original vectors, summed
in order of the dimensions; ties go to the smaller id.

Cases: vectors that are null, empty, zero or hold null, NaN or infinite values
take no part, nor rows without an id; a query never finds rows of its own id;
rows that repeat a query's id ask once, with the smallest vector; repeated
candidate rows are separate results; vectors are compared within their own
length; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, FACTOR, SHARD_ROWS, BLOCK_ROWS, LEAF, EVERY = 20, 1.0, 8192, 4096, 256, 20
FOUND = "query_id long, vec_id long, score double"


class Tree:
    """Vantage-point tree over distinct vectors ``x``; ``ids[i]`` are the
    sorted ids of vector i."""

    def __init__(self, x: np.ndarray, ids: list[np.ndarray], norm: float, seed: int = 1) -> None:
        self.x, self.ids = x, ids
        lift = np.sqrt(np.maximum(norm * norm - (x * x).sum(1), 0.0))
        self.lifted = np.concatenate([x, lift[:, None]], 1)
        self.rng = np.random.default_rng(seed)
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(x)))

    def _build(self, rows: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) > LEAF:
            v = rows[self.rng.integers(len(rows))]
            d = np.sqrt(((self.lifted[rows] - self.lifted[v]) ** 2).sum(1))
            inner = d <= np.median(d)
            if not inner.all():
                self.nodes[at] = (self.lifted[v], d[inner].max(), d[~inner].min(),
                                  self._build(rows[inner]), self._build(rows[~inner]))
                return at
        self.nodes[at] = (rows,)
        return at


class Search:
    """k best of a block of queries in one tree."""

    def __init__(self, tree: Tree, q: np.ndarray, own: np.ndarray, norm: float, k: int, factor: float) -> None:
        self.tree, self.q, self.own, self.k, self.factor = tree, q, own, k, factor
        self.norm, self.qq = norm, (q * q).sum(1)
        self.lifted = np.concatenate([q, np.zeros((len(q), 1))], 1)
        self.least = np.full(len(q), -np.inf)
        self.slack = 1e-9 * (1 + np.sqrt(self.qq) * norm)
        self.best: list[list[tuple[float, int]]] = [[] for _ in range(len(q))]
        if len(tree.x):
            self._visit(tree.root, np.arange(len(q)))

    def _bound(self, rows: np.ndarray) -> np.ndarray:
        """Distance of each query's k-th neighbour so far."""
        return np.sqrt(np.maximum(self.qq[rows] + self.norm ** 2 - 2 * (self.least[rows] - self.slack[rows]), 0.0))

    def _leaf(self, rows: np.ndarray, qs: np.ndarray) -> None:
        near = self.q[qs] @ self.tree.x[rows].T >= (self.least[qs] - self.slack[qs])[:, None]
        a, b = np.nonzero(near)
        for at in range(0, len(a), 1 << 14):
            i, j = a[at:at + (1 << 14)], b[at:at + (1 << 14)]
            exact = np.add.accumulate(self.q[qs[i]] * self.tree.x[rows[j]], axis=1)[:, -1]
            cut = np.flatnonzero(np.diff(i)) + 1
            for lo, hi in zip(np.append(0, cut), np.append(cut, len(i))):
                q = qs[i[lo]]
                mine, got = self.own[q], self.best[q]
                for s, r in zip(exact[lo:hi].tolist(), rows[j[lo:hi]].tolist()):
                    if s >= self.least[q]:
                        got += [(-s, int(v)) for v in self.tree.ids[r][:self.k + 1] if v != mine]
                got.sort()
                del got[self.k:]
                if len(got) == self.k:
                    self.least[q] = -got[-1][0]

    def _visit(self, node: int, qs: np.ndarray) -> None:
        if not len(qs):
            return
        n = self.tree.nodes[node]
        if len(n) == 1:
            self._leaf(n[0], qs)
            return
        point, inner_max, outer_min, inner, outer = n
        d = np.sqrt(((self.lifted[qs] - point) ** 2).sum(1))
        to_inner, to_outer = d - inner_max, outer_min - d
        first = to_inner <= to_outer
        self._visit(inner, qs[first])
        self._visit(outer, qs[~first])
        tight = 1e-9 * (1 + d)
        for child, gap, late in ((outer, to_outer, first), (inner, to_inner, ~first)):
            left = qs[late]
            self._visit(child, left[(gap[late] - tight[late]) * self.factor <= self._bound(left)])


def _tree(ids: np.ndarray, x: np.ndarray, norm: float) -> Tree:
    """The tree of a shard; equal vectors side by side, ids rising within them."""
    order = np.lexsort((ids, *x.T[::-1]))
    ids, x = ids[order], x[order]
    new = np.flatnonzero(np.append(True, (x[1:] != x[:-1]).any(1)))
    return Tree(x[new], np.split(ids, new[1:]), norm)


def _runs(batches):
    """Sorted batches cut into runs of one (dim, shard, asks): ``(key, ids, vectors)``;
    a run may come in several parts."""
    for batch in batches:
        dim, shard, asks, ids = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False))
                                 for c in ("dim", "shard", "asks", "id"))
        edge = np.flatnonzero((np.diff(dim) != 0) | (np.diff(shard) != 0) | (np.diff(asks) != 0)) + 1
        for a, b in zip([0, *edge], [*edge, len(ids)]):
            if a < b:
                flat = np.asarray(batch.column("v").slice(a, b - a).flatten())
                yield (int(dim[a]), int(shard[a]), bool(asks[a])), ids[a:b], flat.reshape(b - a, -1)


def _search(k: int, factor: float, norm: float, block_rows: int):
    def run(batches):
        import pyarrow as pa
        at, tree, parts, held = None, None, [], []

        def asked():
            """The k best of the queries held."""
            own, q = (np.concatenate(c) for c in zip(*held))
            held.clear()
            for a in range(0, len(own), block_rows):
                s = Search(tree, q[a:a + block_rows], own[a:a + block_rows], norm, k, factor)
                cols = list(zip(*[(int(i), v, -m) for i, got in zip(own[a:], s.best) for m, v in got]))
                if cols:
                    yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                           pa.array(cols[2], pa.float64())], ["query_id", "vec_id", "score"])

        for (dim, shard, asks), ids, x in _runs(batches):
            if (dim, shard) != at:
                if held:
                    yield from asked()
                at, tree, parts = (dim, shard), None, []
            if not asks:
                parts.append((ids, x))
                continue
            if tree is None and parts:
                tree, parts = _tree(*(np.concatenate(c) for c in zip(*parts)), norm), []
            if tree is not None:
                held.append((ids, x))
                if sum(len(i) for i, _ in held) >= block_rows:
                    yield from asked()
        if held:
            yield from asked()
    return run


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, v array<double>, dim`` of the rows that take part."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    big = F.lit(float("inf"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
            .filter(F.forall("v", fine) & F.exists("v", lambda x: x != 0))
            .withColumn("dim", F.size("v")))


def deal(rows: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """What is shuffled: every vector once, every query once per shard."""
    mine = F.pmod(F.xxhash64(F.lit(5), F.col("id")), F.lit(shards)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    return (rows.withColumn("shard", mine).withColumn("asks", F.lit(False))
            .unionByName(asked.withColumn("shard", every).withColumn("asks", F.lit(True))))


def nearest(df: DataFrame, queries: DataFrame | None = None, id_col: str = "vec_id",
            vec_col: str = "embedding", k: int = K, factor: float = FACTOR,
            shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``queries`` defaults to the rows of
    ``df`` whose id is divisible by 20."""
    rows = usable(df, id_col, vec_col)
    asked = rows.filter(F.col("id") % EVERY == 0) if queries is None else usable(queries, id_col, vec_col)
    asked = asked.groupBy("id", "dim").agg(F.min("v").alias("v"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    size = rows.agg(F.count("*").alias("n"), F.max(norm2).alias("m")).first()
    shards = max(1, -(-size["n"] // shard_rows))
    norm = float(np.sqrt(size["m"] or 0.0)) * (1 + 1e-12)
    both = deal(rows, asked, shards)
    by = ["dim", "shard"]
    # a few partitions a shard, so that hashing seldom puts two into one
    tasks = min(8 * shards, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = (both.repartition(tasks, *by).sortWithinPartitions(*by, "asks")
             .mapInArrow(_search(k, factor, norm, block_rows), FOUND))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

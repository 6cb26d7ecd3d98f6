"""Order-dependent row features.

A per-key window puts a hot key's rows into one task. Here order inside a
key comes from the global position over (key, order) (range partitioned, so
a hot key spans many tasks), and "the k previous rows of the same key" is an
equi-join on position - k: uniform keys, no skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldcraft.functions.ordered import global_position
from fieldcraft.functions.text import tokens
from fieldcraft.operators.prep import rank_within
from fieldcraft.session import broadcast_if_small, materialize


# ------------------------------------------------------------------ W01
def running_rank(df: DataFrame, key: str, order: str, name: str | None = None) -> DataFrame:
    """1-based occurrence number of the row within its key, in ``order``."""
    name = name or f"{key}_rank"
    r = rank_within(df, [key], [order], "_r0")
    return r.withColumn(name, (F.col("_r0") + 1).cast("long")).drop("_r0")


# ------------------------------------------------------------------ W02 / A17 / F14
def dup_flags(df: DataFrame, subset: Sequence[str], order: str, label: str = "label") -> DataFrame:
    """Duplicate position over ``subset``: 0 unique, 2 first, 3 last,
    1 middle; one-hot ``maybe_0..3`` (tinyint) and ``large2`` = more than two
    non-null labels in the group. Only the group's size, first and last order
    values are needed: one aggregation joined back."""
    subset = list(subset)
    g = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_lo"),
                                F.max(order).alias("_hi"), F.count(label).alias("_nl"))
    j = df.join(g, subset, "left")
    maybe = (F.when(F.col("_n") == 1, 0).when(F.col(order) == F.col("_lo"), 2)
              .when(F.col(order) == F.col("_hi"), 3).otherwise(1))
    j = j.withColumn("maybe", maybe)
    for v in range(4):
        j = j.withColumn(f"maybe_{v}", (F.col("maybe") == v).cast("tinyint"))
    return j.withColumn("large2", (F.col("_nl") > 2).cast("int")).drop("_n", "_lo", "_hi", "_nl", "maybe")


# ------------------------------------------------------------------ W03
#: rows of a window block
BLOCK = 1024


def label_history_seq(train: DataFrame, others: DataFrame, key: str, order: str,
                      label: str = "label", depth: int = 4, keep: Sequence[str] = ()) -> DataFrame:
    """Last-``depth`` labels of the key before each training row (current
    excluded, oldest first, space joined); the sequence string is indexed by
    first appearance over training rows (the first row's empty sequence is
    0). Other rows use the key's last ``depth`` training labels; an unknown
    sequence -> 0. Output ``keep`` + ``seq`` + ``seq_idx``."""
    keep = list(keep)
    cols = list(dict.fromkeys(keep + [key, order, label]))
    r = materialize(rank_within(train.select(*cols), [key], [order], "_r", pos_name="_g"), "history")
    # windows over blocks of consecutive positions, never over a key; a block
    # also holds the last `depth` rows of the one before it
    block = F.floor(F.col("_g") / BLOCK)
    both = F.when(F.col("_g") % BLOCK >= BLOCK - depth, F.array(block, block + 1)).otherwise(F.array(block))
    w = Window.partitionBy("_b").orderBy("_g")
    start = F.col("_g") - F.col("_r")  # of the row's key
    past = [F.when(F.lag("_g", j).over(w) >= start, F.lag(label, j).over(w).cast("string"))
            for j in range(depth, 0, -1)]
    tr = (r.withColumn("_own", block).withColumn("_b", F.explode(both))
          .withColumn("seq", F.array_join(F.array(*past), " ")).filter("_b = _own"))
    vocab = global_position(tr.groupBy("seq").agg(F.min(order).alias("_first")), ["_first"], "_i") \
        .select("seq", F.col("_i").cast("int").alias("seq_idx"))  # one row per distinct sequence
    cnt = train.groupBy(key).agg(F.count(F.lit(1)).alias("_nk"))
    last = (r.join(cnt, key).filter(F.col("_r") >= F.col("_nk") - depth)
             .groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col("_g"), F.col(label)))).alias("_t")))
    last = last.select(key, F.array_join(F.transform("_t", lambda x: x[label].cast("string")), " ")
                       .alias("seq"))
    oth = (others.select(*list(dict.fromkeys(keep + [key])))
                 .join(last, key, "left").withColumn("seq", F.coalesce("seq", F.lit(""))))
    out_tr = tr.select(*keep, "seq")
    out = out_tr.unionByName(oth.select(*keep, "seq"))
    # `seq` is heavily skewed (most histories are all-negative): join the
    # small sequence table by broadcast, behind its counted size, never by a
    # shuffle on `seq` (at most sum(L^k, k<=depth) rows for L distinct labels)
    vocab = broadcast_if_small(vocab, vocab.count(), 64)
    return out.join(vocab, "seq", "left").withColumn("seq_idx", F.coalesce("seq_idx", F.lit(0)))


# ------------------------------------------------------------------ W06 / A12
def pair_token_max(df: DataFrame, left: str, right: str, row_id: str, keep: Sequence[str],
                   left_sep: str = " ", right_sep: str = ",") -> DataFrame:
    """Combination frequency of two multi-valued columns: every ``x1|x2``
    pair of a row is counted over all rows (each occurrence); a row's value
    is the largest count among its pairs. Pairs are aggregated right after
    the explode (map-side partial aggregation)."""
    keep = list(keep)
    pairs = F.flatten(F.transform(tokens(left, left_sep), lambda a: F.transform(
        tokens(right, right_sep), lambda b: F.concat(a, F.lit("|"), b))))
    cnt = df.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("_c"))
    name = f"{left}_{right}_pair_max"
    # the maximum needs every distinct pair of a row once; a null cell has none
    ex = df.select(*keep, F.explode_outer(F.array_distinct(pairs)).alias("pair"))
    return ex.join(cnt, "pair", "left").groupBy(*keep).agg(F.coalesce(F.max("_c"), F.lit(0)).alias(name))


def pair_token_max_bounded(df: DataFrame, left: str, right: str, keep: Sequence[str], left_sep: str = " ",
                           right_sep: str = ",", rounds: int = 4, factor: int = 8) -> tuple[DataFrame, float]:
    """:func:`pair_token_max` without counting every pair, and the share of the
    rows' distinct pairs that were counted. ``keep`` must identify a row.

    A pair cannot occur more often than either of its tokens meets any token of the
    other column, so the smaller of these two sums bounds its count. Pairs are
    counted in rounds of falling bounds. After each, only tokens whose bound exceeds
    the largest count of a row that holds them can still matter; the next round
    counts pairs of such tokens alone. The last round has no lower bound, so every
    maximum is exact. Token sums cost one aggregation of tokens, not of pairs."""
    keep = list(keep)
    name = f"{left}_{right}_pair_max"
    # a row's distinct tokens with how often it holds them, as runs of the sorted cell
    cells = df.select(*keep, *[F.sort_array(F.coalesce(tokens(c, s), F.array().cast("array<string>"))).alias(a)
                               for c, s, a in ((left, left_sep, "_l"), (right, right_sep, "_r"))])
    starts = lambda a: F.filter(F.transform(a, lambda x, i: F.when((i == 0) | (x != F.get(F.col(a), i - 1)), i)),
                                lambda i: i.isNotNull())
    runs = lambda a: F.transform(f"{a}s", lambda at, i: F.struct(
        F.get(F.col(a), at).alias("tok"), (F.coalesce(F.get(F.col(f"{a}s"), i + 1), F.size(a)) - at).alias("p")))
    cells = materialize(cells.withColumns({"_ls": starts("_l"), "_rs": starts("_r")}).select(
        *keep, F.size("_l").alias("_ln"), F.size("_r").alias("_rn"), runs("_l").alias("_l"), runs("_r").alias("_r")), "cells")

    def entries(rows: DataFrame, l: str, r: str, *more: str) -> DataFrame:
        """The tokens of both sides, one row each."""
        one = lambda side, mine: rows.select(*keep, *more, F.lit(side).alias("side"), F.explode(mine).alias("_e"))
        return one("l", l).unionByName(one("r", r)).select(*keep, *more, "side", "_e.*")

    def gathered(some: DataFrame) -> DataFrame:
        """One row per row again, ``l`` and ``r``: its tokens, their numbers and bounds."""
        part = lambda s: F.collect_list(F.when(F.col("side") == s, F.struct("tok", "p", "b"))).alias(s)
        return some.groupBy(*keep).agg(part("l"), part("r"))

    toks = entries(cells, "_l", "_r", "_ln", "_rn")
    bounds = toks.groupBy("side", "tok").agg(F.sum(F.col("p").cast("long") * F.when(F.col("side") == "l", F.col("_rn"))
                                                   .otherwise(F.col("_ln"))).alias("b"))
    bounds = materialize(bounds, "bounds")
    # tokens are moved once, to get their bounds; the rounds then read whole rows
    held = materialize(gathered(toks.drop("_ln", "_rn").join(broadcast_if_small(bounds), ["side", "tok"])), "held")
    total = cells.agg(F.sum(F.size("_l").cast("long") * F.size("_r"))).first()[0] or 0
    top = bounds.agg(F.max("b")).first()[0] or 0

    def pairs(some: DataFrame, low: int, high: int) -> DataFrame:
        """The rows' distinct pairs whose bound is at least ``low`` and below ``high``."""
        cross = F.flatten(F.transform(F.filter("l", lambda a: a["b"] >= low), lambda a: F.transform(
            F.filter("r", lambda b: (b["b"] >= low) & (F.least(a["b"], b["b"]) < high)),
            lambda b: F.struct(a["tok"].alias("x"), b["tok"].alias("y"), (a["p"].cast("long") * b["p"]).alias("n")))))
        return some.select(*keep, F.explode(cross).alias("_e")).select(*keep, "_e.*")

    best, counted, above, could, some = None, 0, top + 1, held, held
    for k in range(rounds):
        low = 0 if k == rounds - 1 else top // factor ** (k + 1)
        counts = materialize(pairs(some, low, above).groupBy("x", "y").agg(
            F.sum("n").alias("c"), F.count(F.lit(1)).alias("rows")), "pairs")
        counted += counts.agg(F.sum("rows")).first()[0] or 0
        now = pairs(could, low, above).join(broadcast_if_small(counts.drop("rows")), ["x", "y"]).groupBy(*keep).agg(F.max("c").alias("c"))
        best = materialize(now if best is None else best.unionByName(now).groupBy(*keep).agg(F.max("c").alias("c")), "best")
        above = low
        if low == 0:
            break
        # tokens that can still raise their row's maximum, by a pair bounded below ``low``
        most = F.coalesce("c", F.lit(0))
        could = held.join(best, keep, "left").filter(most < low).select(
            *keep, *[F.filter(s, lambda t: t["b"] > most).alias(s) for s in ("l", "r")])
        could = materialize(could.filter("size(l) > 0 OR size(r) > 0"), "could")
        if could.isEmpty():
            break
        need = materialize(entries(could, "l", "r").select("side", "tok").distinct(), "need")
        some = gathered(entries(held, "l", "r").join(broadcast_if_small(need), ["side", "tok"], "left_semi"))
    out = (cells.select(*keep).join(best, keep, "left")
           .select(*keep, F.coalesce("c", F.lit(0)).cast("long").alias(name)))
    return out, (counted / total if total else 0.0)


def pair_count_histogram(df: DataFrame, left: str, right: str, left_sep: str = " ",
                         right_sep: str = ",") -> DataFrame:
    """(pair_count, n_pairs): how many distinct pairs occur that many times."""
    pairs = F.flatten(F.transform(tokens(left, left_sep), lambda a: F.transform(
        tokens(right, right_sep), lambda b: F.concat(a, F.lit("|"), b))))
    cnt = df.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("pair_count"))
    return cnt.groupBy("pair_count").agg(F.count(F.lit(1)).alias("n_pairs"))

"""Exact sampling without replacement (P10, P11) by distributed selection.

Rows are ordered by a hash of their id. To cut that order at given ranks nothing
is sorted: a histogram of the hash's leading bits finds, for every cut, the bucket
that it falls into, the next bits are counted inside those buckets only, and after
three rounds the cut is one hash value. A round is one aggregation of narrow rows;
at most 2,048 counts per open bucket reach the driver, however many rows there are.
Rows then compare their hash with the cuts, without a shuffle.

Only if a cut falls between rows of equal hash are these (and no others) numbered
by id, so the sizes are exact even where ids repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcraft.functions.ordered import numbered
from fieldcraft.operators.prep import mult_hash

#: bits of the hash, and of one round
HASH_BITS, STEP = 33, 11


@dataclass(frozen=True)
class Cut:
    """The first rows of a group, by hash: all below ``value``, and ``ties`` of the
    ``equal`` rows at it."""
    value: int
    ties: int
    equal: int


def select_cuts(df: DataFrame, h: str, ranks: Callable[[int], Sequence[int]], group: str | None = None,
                ) -> dict[object, list[Cut]]:
    """Per group (few values; one group without ``group``) the cuts of the hash
    column ``h`` (0 <= h < 2^33) that leave ``ranks(rows of the group)`` rows before
    them."""
    rows = df.select((F.col(group) if group else F.lit(None)).alias("_k"), F.col(h).alias("_h"))
    # open searches: (group, leading bits) -> ranks left inside that bucket
    todo: dict[tuple, list[tuple[int, int]]] = {}
    found: dict[object, list] = {}
    shift = HASH_BITS - STEP
    first = rows.groupBy("_k", F.shiftright("_h", shift).alias("d")).count().collect()
    sizes: dict[object, int] = {}
    for r in first:
        sizes[r["_k"]] = sizes.get(r["_k"], 0) + r["count"]
    wanted = {k: list(ranks(n)) for k, n in sizes.items()}
    for k, cuts in wanted.items():
        found[k] = [None] * len(cuts)
        _descend(sorted((r["d"], r["count"]) for r in first if r["_k"] == k), k, shift, list(enumerate(cuts)), todo, found)
    while todo and shift > 0:
        done_bits, shift = shift, shift - STEP
        opened, todo = todo, {}
        inside = None
        for k, prefix in opened:
            here = F.col("_k").eqNullSafe(F.lit(k)) & (F.shiftright("_h", done_bits) == prefix)
            inside = here if inside is None else inside | here
        counts = rows.filter(inside).groupBy("_k", F.shiftright("_h", shift).alias("d")).count().collect()
        for (k, prefix), left in opened.items():
            mine = sorted((r["d"], r["count"]) for r in counts if r["_k"] == k and r["d"] >> STEP == prefix)
            _descend(mine, k, shift, left, todo, found)
    return found


def _descend(counts, k, shift, left, todo, found) -> None:
    """Sends each rank on to the bucket that holds it, or settles it."""
    for which, rank in left:
        at = rank
        if at <= 0:
            found[k][which] = Cut(-1, 0, 0)
            continue
        for digit, n in counts:
            if at <= n:
                if shift:
                    todo.setdefault((k, digit), []).append((which, at))
                else:
                    found[k][which] = Cut(digit, at, n)
                break
            at -= n


def folds_by_rank(df: DataFrame, id_col: str, ranks: Callable[[int], Sequence[int]], group: str | None = None,
                  seed: int = 2018, name: str = "fold") -> DataFrame:
    """Adds ``name``: how many of the ascending cuts (``ranks(n)`` rows, in hash
    order, per group) a row lies behind."""
    df = df.withColumn("_h", F.coalesce(mult_hash(id_col, seed), F.lit(0).cast("long")))  # null ids come first
    cuts = select_cuts(df, "_h", ranks, group)
    split = [(k, c) for k, cs in cuts.items() for c in cs if 0 < c.ties < c.equal]
    if split:
        # only rows whose hash equals a cut between equal hashes
        tied = None
        for k, c in split:
            here = (F.col("_h") == c.value) & (F.col(group).eqNullSafe(F.lit(k)) if group else F.lit(True))
            tied = here if tied is None else tied | here
        some = numbered(df.filter(tied), [*([group] if group else []), "_h", id_col], "_at")[0]
        start = {(r["_k"], r["_h"]): r["m"] for r in some.groupBy(
            (F.col(group) if group else F.lit(None)).alias("_k"), "_h").agg(F.min("_at").alias("m")).collect()}
        rest = df.filter(~F.coalesce(tied, F.lit(False))).withColumn("_at", F.lit(0).cast("long"))
        df = rest.unionByName(some)
    else:
        start = {}
        df = df.withColumn("_at", F.lit(0).cast("long"))

    def behind(k, c: Cut) -> Column:
        past = F.col("_h") > c.value
        if 0 < c.ties < c.equal:
            past = past | ((F.col("_h") == c.value) & (F.col("_at") - F.lit(start[k, c.value]) >= c.ties))
        return past.cast("int")

    out = None
    for k, cs in cuts.items():
        fold = sum((behind(k, c) for c in cs), F.lit(0)).cast("int")
        out = fold if not group else F.when(F.col(group).eqNullSafe(F.lit(k)), fold) if out is None else \
            out.when(F.col(group).eqNullSafe(F.lit(k)), fold)
    return df.withColumn(name, out if out is not None else F.lit(0)).drop("_h", "_at")


def exact_folds(df: DataFrame, id_col: str, k: int = 5, share: float = 0.2, seed: int = 2018,
                name: str = "fold") -> DataFrame:
    """Folds 0 .. k-1 drawn without replacement: ``int(share * n)`` rows each, the
    last takes what is left."""
    return folds_by_rank(df, id_col, lambda n: [(j + 1) * int(share * n) for j in range(k - 1)], None, seed, name)


def exact_kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 2018, name: str = "fold") -> DataFrame:
    """Shuffled k folds whose sizes differ by one at most, larger ones first."""
    return folds_by_rank(df, id_col, lambda n: [(j + 1) * (n // k) + min(j + 1, n % k) for j in range(k - 1)],
                         None, seed, name)

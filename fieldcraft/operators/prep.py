"""Projections, label handling, splits, joins and unions (P, J, U rows)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcraft.functions.ordered import global_position, numbered


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ P01-P04
def label_last(df: DataFrame, label: str = "label") -> DataFrame:
    """Columns sorted by name with the label last."""
    cols = sorted(c for c in df.columns if c != label)
    return df.select(*cols, *([label] if label in df.columns else []))


def ensure_label(df: DataFrame, label: str = "label", value: int = 0) -> DataFrame:
    """Add a constant label when the column is missing."""
    return df if label in df.columns else df.withColumn(label, F.lit(value))


def fill_missing(df: DataFrame, number=-1, text: str = "-1") -> DataFrame:
    """Null fill: numbers with ``number``, strings with ``text``."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(number, subset=num).fillna(text, subset=txt)


# ------------------------------------------------------------------ P05
def recode_label_str(c) -> Column:
    """'1' -> 1, anything else -> 0."""
    return F.when(_c(c).cast("string") == F.lit("1"), 1).otherwise(0)


def recode_label_pm(c) -> Column:
    """{1, -1} -> {1, 0}; other values kept."""
    return F.when(_c(c) == -1, 0).otherwise(_c(c))


def recode_label_sentinel(c, sentinels: Sequence[int] = (-1, -2)) -> Column:
    """Sentinel labels (e.g. -1 valid, -2 test) -> 0; only the label changes."""
    return F.when(_c(c).isin(*sentinels), 0).otherwise(_c(c))


# ------------------------------------------------------------------ J01 / J02
def merge_tables(log: DataFrame, ad: DataFrame, user: DataFrame, how: str = "inner",
                 drop_user: Sequence[str] = (), label: str = "label") -> DataFrame:
    """Log joined to the ad table on ``aid`` and the user table on ``uid``.

    Dimension sizes are not assumed: AQE turns a join into a broadcast at
    run time when the measured side is small, and splits skewed partitions
    (a hot ``uid``/``aid``) otherwise. Columns sorted, label last."""
    u = user.drop(*drop_user) if drop_user else user
    out = log.join(ad, "aid", how).join(u, "uid", how)
    return label_last(ensure_label(out, label), label)


def merge_splits(train: DataFrame, test: DataFrame, ad: DataFrame, user: DataFrame,
                 kind: int = 0, drop_user: Sequence[str] = (), label: str = "label") -> DataFrame:
    """``kind`` 0 = train then test (test gets label 0), 1 = train, 2 = test."""
    parts = []
    if kind in (0, 1):
        parts.append(merge_tables(train, ad, user, "inner", drop_user, label))
    if kind in (0, 2):
        parts.append(merge_tables(test.drop(label) if label in test.columns else test,
                                  ad, user, "inner", drop_user, label))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


# ------------------------------------------------------------------ P09 / O04
def positional_split(df: DataFrame, order: str, head_frac: float = 0.7,
                     tail_frac: float = 0.3, name: str = "part") -> DataFrame:
    """First ``int(head_frac*n)`` rows -> 'head', last ``int(tail_frac*n)``
    rows -> 'tail'; a row in neither is dropped (the reference's truncation).
    Positions come from the distributed global position, not a global window."""
    pos, n = numbered(df, [order], "_pos")
    h, t = int(head_frac * n), int(tail_frac * n)
    part = (F.when(F.col("_pos") < F.lit(h), F.lit("head"))
             .when(F.col("_pos") >= F.lit(n - t), F.lit("tail")))
    return pos.withColumn(name, part).filter(F.col(name).isNotNull()).drop("_pos")


# ------------------------------------------------------------------ P10
def mult_hash(c, seed: int) -> Column:
    """Deterministic 32-bit multiplicative hash of an integer id and a seed;
    the same arithmetic is available in any SQL engine. The id is reduced
    modulo 2^31 first, so no 64-bit id overflows the product."""
    low = F.pmod(_c(c).cast("long"), F.lit(2147483648))
    return F.pmod(low * F.lit(2654435761) + F.lit(seed), F.lit(4294967296))


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                name: str = "rank0", pos_name: str | None = None) -> DataFrame:
    """0-based row rank inside each group, without a window per group:
    global position over (group, order) minus the group's start, the
    smallest position in the group (a grouped min, partially aggregated
    map-side). A hot group is spread over many range partitions instead of
    one task. ``pos_name`` keeps the global position (consecutive rows of a
    group are consecutive positions)."""
    group = list(group)
    pos = global_position(df, [*group, *order], "_gpos")
    starts = pos.groupBy(*[F.col(g).alias(f"_k{i}") for i, g in enumerate(group)]).agg(F.min("_gpos").alias("_start"))
    same = [F.col(g).eqNullSafe(F.col(f"_k{i}")) for i, g in enumerate(group)]  # a null group is a group
    return (pos.join(starts, same).drop(*[f"_k{i}" for i in range(len(group))])
               .withColumn(name, (F.col("_gpos") - F.col("_start")).cast("long"))
               .withColumnRenamed("_gpos", pos_name or "_gpos")
               .drop("_start", *([] if pos_name else ["_gpos"])))


def stratified_split(df: DataFrame, id_col: str, label: str = "label", test_frac: float = 0.2,
                     seed: int = 2018, name: str = "part") -> DataFrame:
    """Per label, the ``ceil(test_frac * n_label)`` rows first in hash order
    go to 'test', the rest to 'train' (exact per-class proportions); nothing is
    sorted, see ``operators.sampling``."""
    from fieldcraft.operators.sampling import folds_by_rank
    out = folds_by_rank(df, id_col, lambda n: [math.ceil(n * test_frac)], label, seed, "_behind")
    return out.withColumn(name, F.when(F.col("_behind") == 0, "test").otherwise("train")).drop("_behind")


# ------------------------------------------------------------------ P11 / P12
def hash_fold(id_col, k: int, seed: int = 2018) -> Column:
    """Random-like fold from the high bits of a hash of the row id (stable
    across reruns, and the same arithmetic in any SQL engine)."""
    return F.floor(mult_hash(id_col, seed) * F.lit(k) / F.lit(4294967296)).cast("int")


def mod_fold(id_col, k: int) -> Column:
    """Fold = id % k (the SQL-checkable assignment)."""
    return F.pmod(_c(id_col), F.lit(k))


# ------------------------------------------------------------------ S04 / O05
def bounded_scan(df: DataFrame, order: str, max_num: int) -> DataFrame:
    """First ``max_num`` rows in ``order`` (top-k per partition, then merge)."""
    return df.orderBy(order).limit(max_num)


# ------------------------------------------------------------------ J04 / J06
def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], value: str,
           default) -> DataFrame:
    """Left join with a default for a missing key (dictionary ``get``)."""
    return df.join(table.select(*keys, value), list(keys), "left") \
             .withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def realign_scores(ids: DataFrame, scores: DataFrame, keys: Sequence[str] = ("aid", "uid"),
                   score: str = "score", default: float = 0.0) -> DataFrame:
    """Left join of ids to scores, missing score -> ``default``.
    Duplicate key rows on the score side are averaged first so the id side
    keeps its row count."""
    s = scores.groupBy(*keys).agg(F.avg(score).alias(score))
    return lookup(ids, s, keys, score, default)

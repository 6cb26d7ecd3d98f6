"""Counts, distinct counts, means, value filters and token statistics (A, P08,
F04-F07 rows).

Every per-key statistic is an aggregation joined back on the key, never a
window over the key: partial aggregation shrinks a hot key before the
shuffle, and AQE splits a skewed join partition on the way back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcraft.functions.numeric import zscore
from fieldcraft.functions.ordered import global_position
from fieldcraft.operators.prep import rank_within
from fieldcraft.functions.text import distinct_token_count, token_count, tokens, tokens_ws
from fieldcraft.session import broadcast_if_small, materialize


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ A01 / A02
def group_count(df: DataFrame, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """Rows per key combination attached to each row (``new_count_<k1>_<k2>``);
    an existing column of that name is recomputed."""
    keys = list(keys)
    name = name or "new_count_" + "_".join(keys)
    base = df.drop(name) if name in df.columns else df
    cnt = base.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return base.join(cnt, keys, "left")


# ------------------------------------------------------------------ A03
def nunique_join(df: DataFrame, key: str, col: str, name: str | None = None) -> DataFrame:
    """Distinct ``col`` values per ``key`` attached to each row."""
    name = name or f"{key}_active_{col}"
    nu = df.groupBy(key).agg(F.count_distinct(col).alias(name))
    return df.join(nu, key, "left")


# ------------------------------------------------------------------ A04 / E06
def nunique_zscore(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """Distinct count per key, then standardised over the rows of the joined
    table (population std; a zero std divides by 1)."""
    return nunique_recipe(df, [(key, col, name)])


#: values that one task of a distinct count takes in; its hash table holds at most as many
TASK_VALUES = 2_000_000
_SALTS = 16


def deal_values(rows: DataFrame, cols: Sequence[str], values: int) -> DataFrame:
    """``rows`` of ``cols``, holding ``values`` counted values, in as many partitions as
    keep those of each near ``TASK_VALUES``, dealt by their cells, so that equal values
    mostly meet; the rows of a frequent combination go to several. Rows that already
    have enough partitions are returned untouched."""
    parts = -(-values // TASK_VALUES)
    if parts <= rows.rdd.getNumPartitions():
        return rows
    return (rows.withColumn("_salt", F.monotonically_increasing_id() % _SALTS)
            .repartition(parts, *cols, "_salt").drop("_salt"))


def nunique_recipe(df: DataFrame, specs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Several standardised distinct counts, ``specs = [(key, col, name)]``.
    All counts of one key come from one aggregation, written once with the
    number of rows per key; means and stds over the rows are sums over that
    small table weighted by those numbers, so the rows are never joined just
    to be averaged. A row gives one entry per counted column, so the narrow rows
    are written once and dealt to tasks by their number of entries: a few large
    splits would each hold millions of them."""
    keys = list(dict.fromkeys(k for k, _, _ in specs))
    narrow = materialize(df.select(*dict.fromkeys(x for k, c, _ in specs for x in (k, c))), "nunique-rows")
    n_rows = narrow.count()
    out = df
    for key in keys:
        mine = [(c, name) for k, c, name in specs if k == key]
        cols = list(dict.fromkeys([key, *[c for c, _ in mine]]))
        rows = deal_values(narrow.select(*cols).filter(F.col(key).isNotNull()), cols, n_rows * len(mine))
        per = materialize(rows.groupBy(key).agg(
            F.count(F.lit(1)).cast("double").alias("_rows"), *[F.count_distinct(c).alias(n) for c, n in mine]), "nunique")
        w = F.col("_rows")
        mean = per.agg(*[(F.sum(w * F.col(n)) / F.sum(w)).alias(n) for _, n in mine]).first()
        sd = per.agg(*[F.sqrt(F.sum(w * (F.col(n) - F.lit(mean[n] or 0.0)) ** 2) / F.sum(w)).alias(n)
                       for _, n in mine]).first()
        out = out.join(per.select(key, *[zscore(F.col(n).cast("double"), F.lit(mean[n] or 0.0), F.lit(sd[n] or 0.0))
                                         .alias(n) for _, n in mine]), key, "left")
    return out


# ------------------------------------------------------------------ A09
def mean_by_key(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """``<key>_mean_<col>`` for each key, attached to every row."""
    out = df
    for k in keys:
        g = df.groupBy(k).agg(F.avg(col).alias(f"{k}_mean_{col}"))
        out = out.join(g, k, "left")
    return out


# ------------------------------------------------------------------ A05 / A06 / U01
def uid_aid_stats(parts: Sequence[DataFrame], ad: DataFrame, user: str = "uid",
                  item: str = "aid", campaign: str = "campaignId") -> DataFrame:
    """Global id statistics over the union of all splits:
    ``campaignId_aid_nunique`` (from the ad table, deduplicated on aid first),
    ``uid_aid_nunique``, ``aid_uid_nunique`` and ``uid_count`` (non-null aids
    of the uid)."""
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    df = materialize(df, "ids")  # three uses, one reading of the log
    ad1 = ad.select(item, campaign).dropDuplicates([item])
    camp = ad1.groupBy(campaign).agg(F.count_distinct(item).alias("campaignId_aid_nunique"))
    ad_stat = ad1.join(camp, campaign).select(item, "campaignId_aid_nunique")
    u = df.groupBy(user).agg(F.count_distinct(item).alias("uid_aid_nunique"),
                             F.count(item).alias("uid_count"))
    a = df.groupBy(item).agg(F.count_distinct(user).alias("aid_uid_nunique"))
    return df.join(u, user, "left").join(a, item, "left").join(ad_stat, item, "left")


# ------------------------------------------------------------------ A16
def summary_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, n, mean, std, min, max)`` of numeric columns, nulls left
    out, in one aggregation."""
    one = df.agg(*[F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("std"),
                            F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
                   for c in cols])
    row = lambda c: F.struct(F.lit(c).alias("column"),
                             *[F.col(f"{c}.{x}") for x in ("n", "mean", "std", "min", "max")])
    return one.select(F.inline(F.array(*[row(c) for c in cols])))


# ------------------------------------------------------------------ P08 / A19
def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, count) sorted by count descending."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col)


def rare_to_minus1(df: DataFrame, col: str, times: int, missing="-1") -> DataFrame:
    """Values seen fewer than ``times`` times become ``missing``."""
    cnt = df.groupBy(col).agg(F.count(F.lit(1)).alias("_vc"))
    return (df.join(cnt, col, "left")
              .withColumn(col, F.when(F.col("_vc") < times, F.lit(missing)).otherwise(F.col(col)))
              .drop("_vc"))


# ------------------------------------------------------------------ E01
def label_encode(df: DataFrame, col: str, name: str | None = None,
                 numeric_order: bool | None = None) -> DataFrame:
    """Sorted distinct values -> 0..n-1. Integer order when every value
    parses as an integer (or the column is numeric), else string order; the
    crossed strings ``1_23`` / ``12_3`` stay distinct. The distinct set is
    numbered with the distributed global position (no single-task window)."""
    name = name or f"{col}_le"
    dt = df.schema[col].dataType.typeName()
    if numeric_order is None:
        if dt in ("string",):
            bad = df.select(F.count(F.when(F.col(col).isNotNull() & F.col(col).try_cast("long").isNull()
                                           | F.col(col).contains("_"), 1)).alias("b")).first()["b"]
            numeric_order = bad == 0
        else:
            numeric_order = True
    keyed = df.select(col).distinct()
    order_col = F.col(col).cast("long") if (numeric_order and dt == "string") else F.col(col)
    keyed = keyed.withColumn("_ord", order_col)
    idx = global_position(keyed, ["_ord", col], name).select(col, name)
    return df.join(idx, col, "left")


# ------------------------------------------------------------------ E02 / F01
#: stands for a null in a crossed text key, so (null, 'x') and ('x', null) differ
NULL_PART = "\x00"


def cross_encode(df: DataFrame, pairs: Sequence[Sequence[str]], times: int = 100,
                 row_id: str = "row_id") -> DataFrame:
    """For each pair: key ``a_b`` (strings), values seen fewer than ``times``
    times -> '-1', then label-encoded in string order. A pair already present
    (either order) is skipped. All pairs are stacked into one long form
    ``(pair, value)`` for one count aggregation and one distributed dense
    numbering ranked within each pair. A row's codes are then looked up pair by
    pair: only values seen often enough have one of their own, so these tables hold
    at most rows / ``times`` values; every other value has that of '-1'."""
    todo = []
    for a, b in pairs:
        if f"{a}_{b}" in df.columns or f"{b}_{a}" in df.columns or f"{a}_{b}" in [f"{x}_{y}" for x, y in todo]:
            continue
        todo.append((a, b))
    if not todo:
        return df
    value = lambda a, b: F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_PART)) for c in (a, b)])
    ent = F.array(*[F.struct(F.lit(f"{a}_{b}").alias("pair"), value(a, b).alias("v")) for a, b in todo])
    cnt = df.select(F.explode(ent).alias("_e")).groupBy("_e.pair", "_e.v").agg(F.count(F.lit(1)).alias("_vc"))
    mapped = cnt.select("pair", F.when(F.col("_vc") < times, F.lit("-1")).otherwise(F.col("v")).alias("r")).distinct()
    codes = materialize(rank_within(mapped, ["pair"], ["r"], "code"), "codes")
    kind = codes.schema["code"].dataType
    rare = {r["pair"]: r["code"] for r in codes.filter("r = '-1'").collect()}  # one a pair
    size = {r["pair"]: r["n"] for r in codes.groupBy("pair").agg(F.count("*").alias("n")).collect()}
    out = df
    for a, b in todo:
        name = f"{a}_{b}"
        table = codes.filter((F.col("pair") == name) & (F.col("r") != "-1")).select(F.col("r").alias("_r"), F.col("code").alias("_code"))
        # broadcast behind its counted size: a shuffle on the value would have hot keys
        out = (out.join(broadcast_if_small(table, size.get(name, 0), 96), value(a, b) == F.col("_r"), "left")
               .withColumn(name, F.coalesce("_code", F.lit(rare.get(name)).cast(kind))).drop("_r", "_code"))
    return out


# ------------------------------------------------------------------ F05 / F06 / F07
def positional_tokens(df: DataFrame, col: str, max_slots: int = 5, sep: str = " ",
                      missing: str = "-1") -> DataFrame:
    """``<col>_0 .. <col>_{k-1}`` (k = min(max_slots, longest cell)), absent
    slot -> ``missing``; ``<col>_length`` = distinct tokens in the cell."""
    mx = df.agg(F.max(F.size(tokens(col, sep))).alias("m")).first()["m"] or 0
    k = min(max_slots, mx)
    arr = tokens(col, sep)
    cols = [F.coalesce(F.get(arr, i), F.lit(missing)).alias(f"{col}_{i}") for i in range(k)]
    return df.select("*", *cols, distinct_token_count(col, sep).alias(f"{col}_length"))


def token_length(df: DataFrame, col: str, missing: str = "-1") -> DataFrame:
    """``<col>_len`` = whitespace token count, the missing marker -> 0."""
    return df.withColumn(f"{col}_len", token_count(col, missing))


def token_count_by_key(df: DataFrame, key: str, col: str, missing: str = "-1") -> DataFrame:
    """Total tokens of a multi-valued column per key."""
    return df.groupBy(key).agg(F.sum(token_count(col, missing)).cast("long").alias(f"{col}_count_by{key}"))


# ------------------------------------------------------------------ E07 / A15 / vocabularies
def first_seen_vocab(values: DataFrame, value: str, order: Sequence[str], threshold: int,
                     start: int = 2, field: str | None = None) -> DataFrame:
    """Vocabulary of values with count >= ``threshold`` in ``values``,
    indexed from ``start`` in order of first appearance (``order`` columns of
    the first row holding the value); per field when ``field`` is given.
    Numbered with the distributed position helpers: no single-task window
    even when a large table leaves millions of entries above the threshold."""
    first = F.min(F.struct(*[F.col(o) for o in order])).alias("_first")
    g = values.groupBy(*([field] if field else []), value).agg(F.count(F.lit(1)).alias("cnt"), first)
    g = g.filter(F.col("cnt") >= threshold)
    if field:
        r = rank_within(g, [field], ["_first"], "_r")
    else:
        r = global_position(g, ["_first"], "_r")
    return r.withColumn("idx", (F.col("_r") + F.lit(start)).cast("int")).drop("_first", "_r")


def token_vocab(df: DataFrame, col: str, order: str, threshold: int, start: int = 2) -> DataFrame:
    """Whitespace tokens of ``col`` -> (token, cnt, idx) by first
    appearance (row order, then position in the cell)."""
    toks = df.select(order, F.posexplode(tokens_ws(col)).alias("_p", "token"))
    return first_seen_vocab(toks, "token", [order, "_p"], threshold, start)


def value_vocab_lookup(df: DataFrame, col: str, vocab: DataFrame, value: str, name: str,
                       unknown: int = 1) -> DataFrame:
    """Index of a value in a vocabulary, unknown -> ``unknown``."""
    v = vocab.select(F.col(value).alias("_v"), F.col("idx").alias(name))
    v = broadcast_if_small(v, v.count(), 64)   # counted size decides broadcast vs shuffle
    return df.join(v, F.col(col).cast("string") == F.col("_v"), "left") \
             .withColumn(name, F.coalesce(F.col(name), F.lit(unknown))).drop("_v")

"""Information scores and binning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcraft.functions.numeric import PERCENTILE_EDGES, digitize_right, pmi_bucket
from fieldcraft.functions.ordered import global_prefix_sum
from fieldcraft.functions.text import tokens_ws
from fieldcraft.session import broadcast_if_small, ensure_checkpoint_dir, materialize


def _log1p_exp(s: Column) -> Column:
    """log(1 + exp(s)) without overflow for large s."""
    return F.when(s > 30, s + F.log1p(F.exp(-s))).otherwise(F.log1p(F.exp(s)))


def bucket_by_min(df: DataFrame, cols: Sequence[str], cap: float = 1.5) -> DataFrame:
    """Shift each column by its minimum over all rows, cap, bucket to 0..15
    (one decimal, times ten). The minima are one global aggregate."""
    mins = df.agg(*[F.min(c).alias(c) for c in cols]).first()
    out = df
    for c in cols:
        mn = mins[c] if mins[c] is not None else 0.0
        out = out.withColumn(c, pmi_bucket(F.col(c), F.lit(float(mn)), cap))
    return out


# ------------------------------------------------------------------ I01
def pmi_single(df: DataFrame, cond: str, attrs: Sequence[str], bucket: bool = True,
               row_id: str = "row_id") -> DataFrame:
    """``new_inf_<cond>_<a> = log1p(cnt_a * cnt_cond / cnt_(cond,a) / N)`` per
    row, then bucketed (shifted by the column's minimum over all rows).

    All attributes are stacked into one long form ``(row, attr, cond, value)``
    and counted once by (attr, cond, value); that table is checkpointed and
    everything else comes from it without another pass over the rows: the
    marginals ``cnt_a`` (sum over cond) and ``cnt_cond`` (sum over the first
    attribute's values), N, the score and its bucket. Every (attr, cond,
    value) group holds at least one row, so the minimum over the groups is
    the minimum over the rows. Each attribute's scores then go back to the
    rows in one join on (cond, value); Spark broadcasts that table when its
    measured size allows and shuffles otherwise."""
    ensure_checkpoint_dir(df.sparkSession)
    ent = F.array(*[F.struct(F.lit(a).alias("_a"), F.col(a).cast("string").alias("_v")) for a in attrs])
    long = df.select(row_id, cond, F.explode(ent).alias("_e")).select(row_id, cond, "_e._a", "_e._v")
    pair = long.groupBy("_a", cond, "_v").agg(F.count(F.lit(1)).alias("_cij")).checkpoint(eager=True)
    first = pair.filter(F.col("_a") == attrs[0])
    n = first.agg(F.sum("_cij")).first()[0] or 0
    ci = first.groupBy(cond).agg(F.sum("_cij").alias("_ci"))
    cj = pair.groupBy("_a", "_v").agg(F.sum("_cij").alias("_cj"))
    score = (pair.join(cj, ["_a", "_v"]).join(ci, cond)
                 .withColumn("_x", F.log1p(F.col("_cj") * F.col("_ci") / F.col("_cij") / F.lit(float(n)))))
    st = {r["_a"]: r for r in score.groupBy("_a").agg(F.min("_x").alias("_m"), F.count(F.lit(1)).alias("_k"))
                                   .collect()}  # one row per attr
    if bucket:
        mins = {a: r["_m"] for a, r in st.items()}
        score = score.withColumn("_x", F.coalesce(*[
            F.when(F.col("_a") == a, pmi_bucket(F.col("_x"), F.lit(float(mins.get(a) or 0.0)), 1.5))
            for a in attrs]))
    out = df
    for a in attrs:   # one join per attribute with its (cond, value) -> score table
        sa = score.filter(F.col("_a") == a).select(cond, F.col("_v").alias("_va"),
                                                     F.col("_x").alias(f"new_inf_{cond}_{a}"))
        sa = broadcast_if_small(sa, st[a]["_k"] if a in st else 0)
        out = out.withColumn("_va", F.col(a).cast("string")).join(sa, [cond, "_va"], "left").drop("_va")
    return out


# ------------------------------------------------------------------ I02
def pmi_tokens(df: DataFrame, cond: str, keyword: str, row_id: str = "row_id",
               keep: Sequence[str] = (), bucket: bool = True) -> DataFrame:
    """Per token of the row's multi-valued cell (whitespace split):
    ``p = cnt(cond) * cnt(token) / cnt(cond, token) / N``. Row features:
    ``_max`` = log1p(prod p) (the product, as the reference computes it),
    ``_mean`` = log1p(prod p) / tokens, ``_mintok`` = log1p(min p) (the
    per-token minimum the name suggests). Products are summed logs; an empty
    cell gives null. The tokens are counted once by (cond, token); scores are
    made from that table and joined back once, by broadcast where the measured
    size of the table allows it."""
    keep = list(dict.fromkeys([row_id, *keep]))
    n = df.count()
    base = df.select(*keep, *[c for c in (cond, keyword) if c not in keep])
    # explode_outer: a row with an empty cell keeps one null token, so the
    # single group on the row has every row (no join back onto the rows)
    rows = base.select(*list(dict.fromkeys([*keep, cond])), F.explode_outer(tokens_ws(keyword)).alias("tok"))
    toks = rows.filter(F.col("tok").isNotNull())
    condi = materialize(toks.groupBy(cond, "tok").agg(F.count(F.lit(1)).alias("_ct")), "tokens")
    back = condi.groupBy("tok").agg(F.sum("_ct").alias("_b"))
    ccount = base.groupBy(cond).agg(F.count(F.lit(1)).alias("_cc"))
    table = (condi.join(back, "tok").join(ccount, cond)
             .select(cond, "tok", (F.col("_cc") * F.col("_b") / F.col("_ct") / F.lit(float(n))).alias("_p")))
    p = rows.join(broadcast_if_small(table), [cond, "tok"], "left")
    per_row = p.groupBy(*keep).agg(F.sum(F.log("_p")).alias("_s"), F.count("_p").alias("_k"),
                                   F.min("_p").alias("_mn"))
    pre = f"new_inf_{cond}_{keyword}"
    out = per_row.select(*keep, _log1p_exp(F.col("_s")).alias(f"{pre}_max"),
                         (_log1p_exp(F.col("_s")) / F.col("_k")).alias(f"{pre}_mean"),
                         F.log1p(F.col("_mn")).alias(f"{pre}_mintok"))
    cols = [f"{pre}_max", f"{pre}_mean", f"{pre}_mintok"]
    if not bucket:
        return out
    # the minima need every row's score: read them from a checkpoint of the
    # narrow per-row table instead of recomputing the token joins
    ensure_checkpoint_dir(df.sparkSession)
    return bucket_by_min(out.checkpoint(eager=True), cols)


# ------------------------------------------------------------------ E14 / F11
def percentile_edges(df: DataFrame, cols: Sequence[str],
                     percents: Sequence[float] = PERCENTILE_EDGES,
                     approx: bool = False, accuracy: int = 10000) -> dict[str, list[float]]:
    """Percentiles of each column, nulls left out. Exact (linear
    interpolation, as numpy): the distinct values of all columns are counted,
    sorted over all tasks with running counts, and only the two values around
    each percentile come to the driver. ``approx=True`` uses the
    bounded-memory ``percentile_approx`` sketch in one aggregation."""
    fr = [p / 100.0 for p in percents]
    if approx:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), fr, accuracy).alias(c) for c in cols]).first()
        return {c: list(row[c]) for c in cols}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v"))
                                         for c in cols])).alias("e")).select("e.*").filter("v IS NOT NULL")
    counts = materialize(long.groupBy("col", "v").agg(F.count(F.lit(1)).cast("double").alias("k")), "values")
    n = {r["col"]: int(r["n"]) for r in counts.groupBy("col").agg(F.sum("k").alias("n")).collect()}
    start, at = {}, 0
    for c in sorted(n):
        start[c], at = at, at + n[c]
    run = global_prefix_sum(counts, ["col", "v"], ["k"], ["below"])
    spots = {c: [p * (n[c] - 1) for p in fr] for c in n}
    wanted = sorted({start[c] + r for c, s in spots.items() for x in s for r in (math.floor(x), math.ceil(x))})
    if not wanted:
        return {c: [None] * len(fr) for c in cols}
    inside = F.exists(F.array(*[F.lit(float(w)) for w in wanted]),
                      lambda w: (w >= F.col("below")) & (w < F.col("below") + F.col("k")))
    got = [(r["below"], r["k"], r["v"]) for r in run.filter(inside).collect()]
    value = {w: v for w in wanted for b, k, v in got if b <= w < b + k}

    def edge(c: str, x: float) -> float:
        lo, hi = value[start[c] + math.floor(x)], value[start[c] + math.ceil(x)]
        return lo + (hi - lo) * (x - math.floor(x))

    return {c: [edge(c, x) for x in spots[c]] if c in n else [None] * len(fr) for c in cols}


def digitize_percentile(df: DataFrame, cols: Sequence[str],
                        percents: Sequence[float] = PERCENTILE_EDGES, approx: bool = False) -> DataFrame:
    """Replace each column by its right-closed bucket among its percentiles."""
    df = materialize(df, "digitize")  # read for the edges and for the buckets
    edges = percentile_edges(df, cols, percents, approx)
    out = df
    for c in cols:
        out = out.withColumn(c, digitize_right(F.col(c), edges[c]))
    return out


def digitize_fixed(df: DataFrame, col: str, edges: Sequence[float], name: str | None = None) -> DataFrame:
    return df.withColumn(name or col, digitize_right(F.col(col), edges))

"""Target statistics: smoothed conversion rates, leakage-safe out-of-fold
counts, Beta priors, token scores and per-user conversion.

Leave-fold-out statistics are computed by subtraction: one aggregation by
``(key, fold)`` gives each fold's share, the key total is the sum of the
shares, and "all folds but f" is ``total - share_f``. One shuffle replaces k
re-scans, and a hot key never sits in one task (partial aggregation). Rows are
stacked over the crossed keys for that one count only; the statistics, written
once, are then joined onto the rows pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcraft.functions.ordered import numbered
from fieldcraft.functions.text import cross_key, tokens
from fieldcraft.operators.prep import rank_within
from fieldcraft.session import broadcast_if_small, broadcast_limit, materialize

ALL_FOLDS = -1


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- T02 prior
def _digamma_np(x):
    x = np.asarray(x, dtype="float64")
    shift = sum(1.0 / (x + i) for i in range(6))
    y = x + 6.0
    y2 = y * y
    return (np.log(y) - 0.5 / y - 1.0 / (12.0 * y2) + 1.0 / (120.0 * y2 * y2)
            - 1.0 / (252.0 * y2 * y2 * y2)) - shift


def _fpi(tries, hits, misses, iters, eps, a, b):
    """Fixed-point steps over three marginals ``(value, weight)``."""
    (n, wn), (c, wc), (d, wd) = tries, hits, misses
    for _ in range(iters):
        den = float(np.sum(wn * (_digamma_np(n + a + b) - _digamma_np(a + b))))
        if den == 0 or not math.isfinite(den):
            break
        na = a * float(np.sum(wc * (_digamma_np(c + a) - _digamma_np(a)))) / den
        nb = b * float(np.sum(wd * (_digamma_np(d + b) - _digamma_np(b)))) / den
        if not (math.isfinite(na) and math.isfinite(nb)) or na <= 0 or nb <= 0:
            break
        if abs(na - a) < eps and abs(nb - b) < eps:
            break
        a, b = na, nb
    return a, b


def beta_prior_fpi(hist: DataFrame, group_cols: Sequence[str] = (), n: str = "n", c: str = "c",
                   weight: str = "m", iters: int = 1000, eps: float = 1e-3,
                   alpha0: float = 1.0, beta0: float = 1.0) -> DataFrame:
    """Fit Beta(alpha, beta) to (tries n, successes c) by Minka's fixed-point
    iteration over a histogram ``(group..., n, c, m)``; ``m`` = number of keys
    with that (n, c). Stops per group when both parameters move less than
    ``eps`` (keeping the previous pair), after ``iters`` steps, or when a step
    is not finite. Returns ``(group..., alpha, beta)``, one row per group; a
    null group is a group.

    A step only needs how often each value of n, of c and of n - c occurs, so
    the histogram is summed to these three marginals and every group is
    iterated where its marginals are, all groups in parallel. Distinct counts
    that sum to N rows number at most sqrt(2 N): a group's marginals stay a few
    million values even for 10^12 rows."""
    gcols = list(group_cols)
    keys = [F.col(g).alias(f"_g{i}") for i, g in enumerate(gcols)] or [F.lit(0).alias("_g0")]
    names = [f"_g{i}" for i in range(max(1, len(gcols)))]
    count, hit = F.col(n).cast("double"), F.col(c).cast("double")
    parts = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value"))
                      for k, v in enumerate((count, hit, count - hit))])
    marg = (hist.select(*keys, F.col(weight).cast("double").alias("m"), F.explode(parts).alias("e"))
            .groupBy(*names, "e.kind", "e.value").agg(F.sum("m").alias("m")))
    types = [marg.schema[x] for x in names]
    schema = T.StructType([*types, T.StructField("alpha", T.DoubleType()), T.StructField("beta", T.DoubleType())])

    def fit(key, pdf):
        import pandas as pd
        part = [pdf[pdf["kind"] == k] for k in range(3)]
        a, b = _fpi(*[(p["value"].to_numpy(), p["m"].to_numpy()) for p in part], iters, eps, alpha0, beta0)
        key = [None if k != k else k for k in key]
        return pd.DataFrame([[*key, float(a), float(b)]], columns=[*names, "alpha", "beta"])

    # few bytes but many steps: dealt by number, or all groups would be joined into one task
    marg = marg.repartition(hist.sparkSession.sparkContext.defaultParallelism, *names)
    out = marg.groupBy(*names).applyInPandas(fit, schema)
    return out.select(*[F.col(x).alias(g) for x, g in zip(names, gcols)], "alpha", "beta")


def key_histogram(stats: DataFrame, group_cols: Sequence[str] = (), n: str = "n",
                  c: str = "c") -> DataFrame:
    """(group..., n, c, m): how many keys have n tries and c successes."""
    return stats.groupBy(*group_cols, n, c).agg(F.count(F.lit(1)).alias("m"))


# ---------------------------------------------------------------- T01
def smoothed_rate(train: DataFrame, target: DataFrame, keys: Sequence[str], name: str,
                  label: str = "label", alpha: float | None = 1.0, beta: float | None = 1.0,
                  fit_prior: bool = False, iters: int = 1000, eps: float = 1e-3,
                  scale: float = 100.0, digits: int = 8) -> DataFrame:
    """Per-key rate ``(sum+alpha)/(count+alpha+beta)`` fitted on ``train``,
    left-joined to ``target``; unseen key -> ``alpha/(alpha+beta)``; output
    ``bround(scale * rate, digits)``. ``fit_prior`` re-estimates alpha, beta
    by fixed-point iteration (T02) from the per-key counts."""
    st = rate_counts(train, keys, label)
    alpha, beta = (1.0 if x is None else x for x in (alpha, beta))
    if fit_prior:
        alpha, beta = rate_prior(st, alpha, beta, iters, eps)
    return apply_rate(target, st, keys, name, alpha, beta, scale, digits)


def rate_counts(train: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """``keys..., _s, _n``: positives and rows per key."""
    return train.groupBy(*keys).agg(F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).alias("_s"),
                                    F.count(F.lit(1)).alias("_n"))


def rate_prior(counts: DataFrame, alpha: float = 1.0, beta: float = 1.0, iters: int = 1000,
               eps: float = 1e-3) -> tuple[float, float]:
    """Prior fitted to the counts of all keys."""
    pr = beta_prior_fpi(key_histogram(counts, (), "_n", "_s"), (), n="_n", c="_s", iters=iters, eps=eps,
                        alpha0=alpha, beta0=beta).first()
    return (pr["alpha"], pr["beta"]) if pr else (alpha, beta)


def apply_rate(target: DataFrame, counts: DataFrame, keys: Sequence[str], name: str, alpha: float, beta: float,
               scale: float = 100.0, digits: int = 8) -> DataFrame:
    """``target`` with the smoothed rate of its key; an unseen key gets the prior's mean."""
    keys = list(keys)
    a, b = F.lit(float(alpha)), F.lit(float(beta))
    rate = (F.col("_s") + a) / (F.col("_n") + a + b)
    return (target.join(counts.withColumn("_r", rate).select(*keys, "_r"), keys, "left")
                  .withColumn(name, F.bround(F.lit(scale) * F.coalesce(F.col("_r"), a / (a + b)), digits))
                  .drop("_r"))


# ---------------------------------------------------------------- T03
def _stack_keys(df: DataFrame, pairs: Sequence[Sequence[str]], keep: Sequence[str]) -> DataFrame:
    """Long form: one row per (input row, pair) with the crossed key."""
    entries = [F.struct(F.lit("_".join(p)).alias("pair"), cross_key(*p).alias("key")) for p in pairs]
    return df.select(*keep, F.explode(F.array(*entries)).alias("_e")) \
             .select(*keep, "_e.pair", "_e.key")


def leave_fold_out_stats(long: DataFrame, group: Sequence[str], fold: str, is_train: Column,
                         label: str = "label") -> DataFrame:
    """Per (group..., lk_fold): sums ``s`` and counts ``n`` over training rows
    outside the fold, and the totals ``ts``, ``tn``; ``lk_fold = -1`` holds the
    all-train totals used for other rows. A key has a row for the folds that it
    occurs in; outside any other fold lie its totals."""
    group = list(group)
    share = (long.filter(is_train)
                 .groupBy(*group, F.col(fold).alias("lk_fold"))
                 .agg(F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).alias("s"),
                      F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy(*group)  # at most k+0 rows per key: bounded
    with_tot = share.withColumn("ts", F.sum("s").over(w)).withColumn("tn", F.sum("n").over(w))
    outside = with_tot.select(*group, "lk_fold", (F.col("ts") - F.col("s")).alias("s"),
                              (F.col("tn") - F.col("n")).alias("n"), "ts", "tn")
    totals = with_tot.groupBy(*group).agg(F.first("ts").alias("s"), F.first("tn").alias("n")) \
                     .select(*group, F.lit(ALL_FOLDS).cast(share.schema["lk_fold"].dataType)
                             .alias("lk_fold"), "s", "n", F.col("s").alias("ts"), F.col("n").alias("tn"))
    return outside.unionByName(totals)


def leave_fold_out_histogram(stats: DataFrame, by: Sequence[str] = ("pair",)) -> DataFrame:
    """(by..., lk_fold, n, c, m) over *all* keys with rows outside the fold:
    the histogram of the totals, for each fold corrected by the keys that
    occur in it. ``stats`` is the output of ``leave_fold_out_stats``."""
    by = list(by)
    inside = stats.filter(F.col("lk_fold") != ALL_FOLDS)
    every = (stats.filter(F.col("lk_fold") == ALL_FOLDS).groupBy(*by, "n", "s")
             .agg(F.count(F.lit(1)).alias("m")))
    folds = stats.select(*[F.col(b).alias(f"_{b}") for b in by], "lk_fold").distinct()  # pairs x folds
    rows = every.join(F.broadcast(folds), [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by])
    parts = [rows.select(*by, "lk_fold", "n", "s", "m"),
             inside.select(*by, "lk_fold", "n", "s", F.lit(1).cast("long").alias("m")),
             inside.select(*by, "lk_fold", F.col("tn").alias("n"), F.col("ts").alias("s"),
                           F.lit(-1).cast("long").alias("m"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return (out.groupBy(*by, "lk_fold", "n", F.col("s").alias("c")).agg(F.sum("m").alias("m"))
            .filter("n > 0 AND m > 0"))


def oof_smoothed_rate(df: DataFrame, pairs: Sequence[Sequence[str]], keep: Sequence[str],
                      is_train: Column, fold: str = "fold", label: str = "label",
                      alpha: float = 1.0, beta: float = 1.0, fit_prior: bool = False,
                      iters: int = 1000, eps: float = 1e-3, scale: float = 100.0,
                      digits: int = 8) -> DataFrame:
    """Out-of-fold smoothed rate for several crossed keys at once.

    Training rows get the rate from training rows of the other folds; other
    rows get it from all training rows. With ``fit_prior`` the Beta prior is
    re-estimated for every (pair, left-out fold) and for (pair, all) in one
    grouped fixed-point iteration. Output: ``keep`` columns + one
    ``<a>_<b>_stas`` column per pair; keyed by the input rows (no join on
    non-unique ids)."""
    stats, pri = oof_rate_state(df, pairs, is_train, fold, label, alpha, beta, fit_prior, iters, eps)
    return apply_oof_rate(df, stats, pri, pairs, keep, is_train, fold, alpha, beta, scale, digits)


def oof_rate_state(df: DataFrame, pairs: Sequence[Sequence[str]], is_train: Column, fold: str = "fold",
                   label: str = "label", alpha: float = 1.0, beta: float = 1.0, fit_prior: bool = False,
                   iters: int = 1000, eps: float = 1e-3) -> tuple[DataFrame, DataFrame | None]:
    """What is fitted: the statistics outside each fold of every pair's keys, and
    with ``fit_prior`` the priors per pair and fold, both written."""
    used = [c for p in pairs for c in p]
    base = df.select(*dict.fromkeys([*used, fold, label]), is_train.alias("_train"))
    long = _stack_keys(base, pairs, [fold, label, "_train"])
    stats = materialize(leave_fold_out_stats(long, ["pair", "key"], fold, F.col("_train"), label), "outside")
    if not fit_prior:
        return stats, None
    return stats, materialize(beta_prior_fpi(leave_fold_out_histogram(stats), ["pair", "lk_fold"], iters=iters,
                                             eps=eps, alpha0=alpha, beta0=beta), "priors")


def apply_oof_rate(df: DataFrame, stats: DataFrame, pri: DataFrame | None, pairs: Sequence[Sequence[str]],
                   keep: Sequence[str], is_train: Column, fold: str = "fold", alpha: float = 1.0, beta: float = 1.0,
                   scale: float = 100.0, digits: int = 8) -> DataFrame:
    """``keep`` and one rate per pair: training rows read the statistics outside
    their fold, other rows those of all folds."""
    keep = list(keep)
    used = [c for p in pairs for c in p]
    base = df.select(*dict.fromkeys([*keep, *used, fold]), is_train.alias("_train"))
    rows = _with_lookup_fold(base, stats, fold)
    lookups = _pair_lookups(stats)
    names = ["_".join(p) for p in pairs]
    fixed = F.lit(float(alpha)), F.lit(float(beta))
    scaled = lambda rate: F.bround(F.lit(scale) * rate, digits)
    if pri is not None:  # one row per fold: what keys without rows outside it get, for every pair
        unseen = pri.groupBy(F.col("lk_fold").alias("_pf")).agg(*[
            F.max(F.when(F.col("pair") == n, F.struct("alpha", "beta"))).alias(f"_p{i}") for i, n in enumerate(names)])
        rows = rows.join(F.broadcast(unseen), F.col("_lk") == F.col("_pf"), "left").drop("_pf")
    for i, (name, p) in enumerate(zip(names, pairs)):
        def rates(table: DataFrame, name: str = name) -> DataFrame:
            """Rates made per key, not per row."""
            a, b = fixed
            if pri is not None:
                ab = pri.filter(F.col("pair") == name).select(F.col("lk_fold").alias("_pf"), "alpha", "beta")
                table = table.join(F.broadcast(ab), F.col("_f") == F.col("_pf"), "left")
                a, b = F.coalesce("alpha", a), F.coalesce("beta", b)
            rate = (F.col("_s") + a) / (F.col("_n") + a + b)
            return table.filter("_n > 0").select("_key", "_f", scaled(rate).alias("_v"))

        rows = _join_pair(rows, lookups(name, rates), p)
        a, b = fixed
        if pri is not None:
            a, b = F.coalesce(f"_p{i}.alpha", a), F.coalesce(f"_p{i}.beta", b)
        rows = rows.withColumn(f"{name}_stas", F.coalesce("_v", scaled(a / (a + b)))).drop("_v", f"_p{i}")
    return rows.select(*keep, *[f"{n}_stas" for n in names])


def _with_lookup_fold(base: DataFrame, stats: DataFrame, fold: str) -> DataFrame:
    """The fold whose statistics a row reads: its own for training rows."""
    lk = F.when(F.col("_train"), F.col(fold)).otherwise(F.lit(ALL_FOLDS))
    return base.withColumn("_lk", lk.cast(stats.schema["lk_fold"].dataType))


def _pair_lookups(stats: DataFrame):
    """Statistics of one pair, or what is ``made`` of them row by row, broadcast behind the measured size of its rows
    (all sizes in one aggregate); a larger table is joined by shuffle."""
    limit = broadcast_limit(stats.sparkSession)
    size = {r["pair"]: r["b"] for r in stats.groupBy("pair").agg(
        F.sum(F.octet_length("key") + F.lit(64)).alias("b")).collect()}

    def one(name: str, made=lambda t: t) -> DataFrame:
        t = made(stats.filter(F.col("pair") == name).select(
            F.col("key").alias("_key"), F.col("lk_fold").alias("_f"), F.col("s").alias("_s"), F.col("n").alias("_n")))
        return F.broadcast(t) if 0 <= size.get(name, 0) <= limit else t
    return one


def _join_pair(rows: DataFrame, table: DataFrame, pair: Sequence[str]) -> DataFrame:
    on = (cross_key(*pair) == F.col("_key")) & (F.col("_lk") == F.col("_f"))
    return rows.join(table, on, "left").drop("_key", "_f")


# ---------------------------------------------------------------- T05 / T07
def oof_pos_neg(df: DataFrame, keys: Sequence[Sequence[str] | str], keep: Sequence[str],
                is_train: Column, fold: str = "fold", label: str = "label",
                missing: int = -1) -> DataFrame:
    """Out-of-fold positive / negative counts per key (one or several keys,
    each a column or a tuple of columns crossed without ambiguity).
    Training rows count the other folds; other rows count all training rows;
    a key with no rows there gets ``missing`` for both. Output columns
    ``<key>_positive_num``, ``<key>_negative_num``."""
    keep = list(keep)
    pairs = [[k] if isinstance(k, str) else list(k) for k in keys]
    used = [c for p in pairs for c in p]
    base = df.select(*dict.fromkeys([*keep, *used, fold, label]), is_train.alias("_train"))
    extra = [c for c in (fold, label) if c not in keep]
    long = _stack_keys(base, pairs, keep + extra + ["_train"])
    stats = materialize(leave_fold_out_stats(long, ["pair", "key"], fold, F.col("_train"), label), "outside")
    rows = _with_lookup_fold(base, stats, fold)
    lookups = _pair_lookups(stats)
    for p in pairs:
        name = "_".join(p)
        rows, seen = _join_pair(rows, lookups(name), p), F.col("_n") > 0
        rows = (rows.withColumn(f"{name}_positive_num", F.when(seen, F.col("_s")).otherwise(F.lit(missing)).cast("long"))
                .withColumn(f"{name}_negative_num", F.when(seen, F.col("_n") - F.col("_s")).otherwise(F.lit(missing)).cast("long"))
                .drop("_s", "_n"))
    return rows.select(*keep, *[f"{'_'.join(p)}_{side}_num" for p in pairs for side in ("positive", "negative")])


# ---------------------------------------------------------------- T04
def token_noisy_or(df: DataFrame, cell: str, row_id: str, is_train: Column, keep: Sequence[str],
                   label: str = "label", alpha: float = 1.0, beta: float = 1.0,
                   fit_prior: bool = False, iters: int = 1000, eps: float = 1e-8,
                   missing: str = "-1", sep: str = " ", digits: int = 8) -> DataFrame:
    """Multi-valued score: per token (count, positives) on training rows;
    row score = product over its tokens (each occurrence) that have at least
    one positive of ``1 - (pos+alpha)/(cnt+alpha+beta)``; others skipped; a
    missing cell scores -1.0. The product is taken as exp(sum(log)) so long
    token lists neither underflow nor depend on factor order beyond the last
    bits; every factor is > 0 because beta > 0. Output ``<cell>_score``."""
    keep = list(keep)
    base = df.select(*keep, *[c for c in (row_id, cell, label) if c not in keep],
                     is_train.alias("_train"))
    toks = base.select(row_id, "_train", label, F.explode(tokens(cell, sep)).alias("tok"))
    st = (toks.filter("_train")
              .groupBy("tok")
              .agg(F.count(F.lit(1)).alias("cnt"),
                   F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).alias("pos"))
              .filter(F.col("pos") > 0))
    st = materialize(st, "token-counts")  # read for the prior and for the rows
    if fit_prior:
        pr = beta_prior_fpi(key_histogram(st, (), "cnt", "pos"), (), n="cnt", c="pos", iters=iters, eps=eps,
                            alpha0=alpha, beta0=beta).first()
        alpha, beta = (pr["alpha"], pr["beta"]) if pr else (alpha, beta)
    a, b = F.lit(float(alpha)), F.lit(float(beta))
    factor = F.lit(1.0) - (F.col("pos") + a) / (F.col("cnt") + a + b)
    per_row = (toks.join(broadcast_if_small(st), "tok")
                   .groupBy(row_id).agg(F.sum(F.log(factor)).alias("_ls")))
    name = f"{cell}_score"
    return (base.join(per_row, row_id, "left")
                .withColumn(name, F.when(F.col(cell) == F.lit(missing), F.lit(-1.0))
                                   .otherwise(F.bround(F.exp(F.coalesce("_ls", F.lit(0.0))), digits)))
                .select(*keep, name))


# ---------------------------------------------------------------- T06 / T08 / A11 / A12
def contiguous_fold(df: DataFrame, order: str, k: int, holdout: int = 0,
                    name: str = "cfold") -> DataFrame:
    """Position in ``order`` -> contiguous fold: ``interval = last // k``,
    fold = min(pos // interval, k-1); the last ``holdout`` rows get fold -2
    (scored from the head). Adds ``pos`` and ``name``."""
    pos, n = numbered(df, [order], "pos")
    last = n - holdout
    interval = max(last // k, 1)
    f = F.least(F.floor(F.col("pos") / F.lit(interval)), F.lit(k - 1)).cast("int")
    return pos.withColumn(name, F.when(F.col("pos") >= F.lit(last), F.lit(-2)).otherwise(f))


def _contig_token_stats(train_f: DataFrame, cell: str, sep: str, label: str):
    toks = train_f.select("cfold", label, F.explode(tokens(cell, sep)).alias("tok"))
    head = toks.filter(F.col("cfold") >= 0)
    share = (head.groupBy("tok", "cfold")
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).alias("s")))
    w = Window.partitionBy("tok")  # <= k rows per token
    share = share.withColumn("tn", F.sum("n").over(w)).withColumn("ts", F.sum("s").over(w))
    outside = share.select("tok", F.col("cfold").alias("lk"), (F.col("tn") - F.col("n")).alias("n"),
                           (F.col("ts") - F.col("s")).alias("s"))
    total = share.groupBy("tok").agg(F.first("tn").alias("n"), F.first("ts").alias("s")) \
                 .select("tok", F.lit(-1).alias("lk"), "n", "s")
    return outside.unionByName(total), total


def contig_fold_token_max(train: DataFrame, others: DataFrame, cell: str, order: str,
                          keep: Sequence[str], k: int = 5, label: str = "label",
                          holdout: int = 0, mode: str = "pos", sep: str = " ") -> DataFrame:
    """Contiguous-fold token features of a multi-valued cell.

    ``mode='pos'`` (T06): token value = positives + 1 when the token occurs
    in the counting rows, else 0; row value = max over its tokens.
    ``mode='rate'`` (T08): ``b = n // distinct tokens``, ``a = b / 20``;
    token value = (a + pos) / (b + cnt), unseen 0.05; row = max.
    Training rows count the other contiguous folds, hold-out tail and other
    rows count the whole head. A null cell has no tokens: its row gets the value
    of an unseen token. Output ``keep`` + ``<cell>_<mode>_max``."""
    keep = list(keep)
    tf = contiguous_fold(train.select(*keep, *[c for c in (order, cell, label) if c not in keep]),
                         order, k, holdout)
    stats, total = _contig_token_stats(tf, cell, sep, label)
    allrows = (tf.select(*keep, cell, F.when(F.col("cfold") >= 0, F.col("cfold"))
                         .otherwise(F.lit(-1)).alias("lk"))
                 .unionByName(others.select(*keep, cell, F.lit(-1).alias("lk"))))
    # a null cell keeps its row, as one without any known token
    rt = allrows.select(*keep, "lk", F.posexplode_outer(tokens(cell, sep)).alias("tpos", "tok"))
    j = rt.join(stats, ["tok", "lk"], "left")
    name = f"{cell}_{mode}_max"
    if mode == "pos":
        val = F.when(F.col("n") > 0, F.col("s") + 1).otherwise(F.lit(0)).cast("long")
    else:
        n_head = tf.filter(F.col("cfold") >= 0).count()
        n_tok = tf.select(F.explode(tokens(cell, sep)).alias("t")).distinct().count()
        b = n_head // max(n_tok, 1)
        a = b * 1.0 / 20
        val = F.when(F.col("n") > 0, (F.lit(a) + F.col("s")) / (F.lit(float(b)) + F.col("n"))) \
               .otherwise(F.lit(0.05))
    return j.groupBy(*keep).agg(F.max(val).alias(name))


def count_of_counts(train: DataFrame, cell: str, label: str = "label", sep: str = " ",
                    with_minus_one: bool = True) -> DataFrame:
    """Histogram of per-token positive counts over ``train`` (A12):
    ``(pos_count, n_tokens)``; T06's variant adds the row (-1, 0)."""
    st = (train.select(label, F.explode(tokens(cell, sep)).alias("tok"))
               .groupBy("tok").agg(F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).alias("pos_count")))
    h = st.groupBy("pos_count").agg(F.count(F.lit(1)).alias("n_tokens"))
    if with_minus_one:
        spark = train.sparkSession
        h = h.unionByName(spark.createDataFrame([(-1, 0)], "pos_count long, n_tokens long"))
    return h


# ---------------------------------------------------------------- T09
def user_conversion_loo(df: DataFrame, keep: Sequence[str], is_train: Column, user: str = "uid",
                        item: str = "aid", label: str = "label") -> DataFrame:
    """Per-user conversion rate from training rows. A training row leaves out
    one occurrence of its own item from the positive list and one from the
    negative list (where present); other rows use the full lists. Rate =
    pos / (pos + neg), -1 when empty or the user has no training rows.
    Only counts are needed: no per-user list is materialised."""
    keep = list(keep)
    base = df.select(*keep, *[c for c in (user, item, label) if c not in keep],
                     is_train.alias("_train"))
    tr = base.filter("_train")
    pos = F.when(F.col(label) > 0, 1).otherwise(0)
    neg = F.when(F.col(label) > 0, 0).otherwise(1)
    per_user = tr.groupBy(user).agg(F.sum(pos).alias("up"), F.sum(neg).alias("un"))
    per_pair = tr.groupBy(user, item).agg((F.sum(pos) > 0).cast("int").alias("hp"),
                                          (F.sum(neg) > 0).cast("int").alias("hn"))
    j = base.join(per_user, user, "left").join(per_pair, [user, item], "left")
    drop_p = F.when(F.col("_train"), F.coalesce("hp", F.lit(0))).otherwise(F.lit(0))
    drop_n = F.when(F.col("_train"), F.coalesce("hn", F.lit(0))).otherwise(F.lit(0))
    p = F.coalesce("up", F.lit(0)) - drop_p
    n = F.coalesce("un", F.lit(0)) - drop_n
    return j.select(*keep, p.alias("pos_num"), n.alias("neg_num"),
                    F.when(p + n > 0, p / (p + n)).otherwise(F.lit(-1.0)).alias("uid_convert"))


def row_item_lists(df: DataFrame, keep: Sequence[str], is_train: Column, order: str = "row_id",
                   user: str = "uid", item: str = "aid", label: str = "label") -> DataFrame:
    """Per row: its user's positive and negative items from training rows, in
    row order, space separated; a training row's own item leaves each list
    once (its first occurrence there). Users without training rows get empty
    lists. The lists are the feature: a row's cell is as long as its user's
    history."""
    lists = user_item_lists(df, is_train, order, user, item, label).select(
        F.col(user).alias("_u"), "pos_aid", "neg_aid")
    j = df.join(lists, F.col(user).eqNullSafe(F.col("_u")), "left")

    def cell(name: str) -> Column:
        have = F.split(F.when(F.col(name) != "", F.col(name)), " ")
        at = F.array_position(have, F.col(item).cast("string")).cast("int")
        rest = F.when(is_train & (at > 0), F.concat(
            F.slice(have, F.lit(1), at - 1), F.slice(have, at + 1, F.size(have)))).otherwise(have)
        return F.coalesce(F.array_join(rest, " "), F.lit("")).alias(name)

    return j.select(*keep, cell("pos_aid"), cell("neg_aid"))


def user_item_lists(df: DataFrame, is_train: Column, order: str = "row_id", user: str = "uid",
                    item: str = "aid", label: str = "label") -> DataFrame:
    """Per-user positive and negative item lists from training rows, in row
    order, space separated: ``(uid, pos_aid, neg_aid, uid_convert)``. The list
    length is the user's own row count (the feature is the list)."""
    tr = df.filter(is_train)
    ent = F.struct(F.col(order).alias("o"), F.col(item).cast("string").alias("v"))
    g = tr.groupBy(user).agg(
        F.array_sort(F.collect_list(F.when(F.col(label) > 0, ent))).alias("p"),
        F.array_sort(F.collect_list(F.when(F.col(label) <= 0, ent))).alias("q"))
    np_, nq = F.size("p"), F.size("q")
    return g.select(user,
                    F.array_join(F.transform("p", lambda x: x["v"]), " ").alias("pos_aid"),
                    F.array_join(F.transform("q", lambda x: x["v"]), " ").alias("neg_aid"),
                    F.when(np_ + nq > 0, np_ / (np_ + nq)).otherwise(F.lit(-1.0)).alias("uid_convert"))


# ---------------------------------------------------------------- T09 / A14 in segments
SEGMENT = 1000


def ranked_items(df: DataFrame, is_train: Column, order: str = "row_id", user: str = "uid", item: str = "aid",
                 label: str = "label") -> DataFrame:
    """Training rows as list entries, written once: ``(user, side, at, item)``, ``side``
    pos or neg and ``at`` the entry's place in its user's list of that side. Places
    come from global positions, so a user with a third of all rows is numbered by many
    tasks."""
    rows = df.filter(is_train).select(
        F.col(user).alias("user"), F.when(F.col(label) > 0, "pos").otherwise("neg").alias("side"),
        F.col(order).alias("o"), F.col(item).cast("string").alias("item"))
    return materialize(rank_within(rows, ["user", "side"], ["o", "item"], "at").drop("o"), "list-entries")


def list_segments(entries: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Lists cut into segments of at most ``segment`` items: ``(user, side, segment,
    items, n)``. No row is longer than a segment, whatever the user's history."""
    return (entries.withColumn("segment", F.floor(F.col("at") / segment).cast("long"))
            .groupBy("user", "side", "segment")
            .agg(F.sort_array(F.collect_list(F.struct("at", "item"))).alias("_e"), F.count(F.lit(1)).alias("n"))
            .select("user", "side", "segment", F.transform("_e", lambda e: e["item"]).alias("items"), "n"))


def list_positions(df: DataFrame, entries: DataFrame, segments: DataFrame, keep: Sequence[str], is_train: Column,
                   user: str = "uid", item: str = "aid") -> DataFrame:
    """Per row what its lists are, without the lists: ``keep, user, pos_num, neg_num``
    (own item left out), ``pos_skip, neg_skip`` (the place of a training row's own item
    in either list, null if it is not there) and ``uid_convert``."""
    sizes = segments.groupBy("user").agg(*[
        F.sum(F.when(F.col("side") == s, F.col("n")).otherwise(0)).alias(f"_{s}") for s in ("pos", "neg")])
    own = entries.groupBy(F.col("user").alias("_u"), F.col("item").alias("_i")).agg(*[
        F.min(F.when(F.col("side") == s, F.col("at"))).alias(f"_{s}_at") for s in ("pos", "neg")])
    rows = df.select(*keep, F.col(user).alias("user"), F.col(item).cast("string").alias("_item"), is_train.alias("_train"))
    j = (rows.join(sizes.withColumnRenamed("user", "_us"), F.col("user").eqNullSafe(F.col("_us")), "left")
         .join(own, F.col("user").eqNullSafe(F.col("_u")) & F.col("_item").eqNullSafe(F.col("_i")), "left"))
    skip = {s: F.when(F.col("_train"), F.col(f"_{s}_at")) for s in ("pos", "neg")}
    num = {s: F.coalesce(F.col(f"_{s}"), F.lit(0)) - skip[s].isNotNull().cast("int") for s in ("pos", "neg")}
    total = num["pos"] + num["neg"]
    return j.select(*keep, "user", num["pos"].cast("long").alias("pos_num"), num["neg"].cast("long").alias("neg_num"),
                    skip["pos"].alias("pos_skip"), skip["neg"].alias("neg_skip"),
                    F.when(total > 0, num["pos"] / total).otherwise(F.lit(-1.0)).alias("uid_convert"))


def read_lists(positions: DataFrame, segments: DataFrame, keep: Sequence[str], segment: int = SEGMENT) -> DataFrame:
    """The lists of each row, segment by segment: ``keep, side, segment, items``, its
    own item left out at its place. Rows of users without entries have none."""
    skip = F.when(F.col("side") == "pos", F.col("pos_skip")).otherwise(F.col("neg_skip")) - F.col("segment") * segment
    at = F.col("_skip").cast("int")
    rest = F.when((at >= 0) & (at < F.size("items")), F.concat(
        F.slice("items", F.lit(1), at), F.slice("items", at + 2, F.size("items")))).otherwise(F.col("items"))
    s = segments.withColumnRenamed("user", "_u")
    return (positions.join(s, F.col("user").eqNullSafe(F.col("_u"))).withColumn("_skip", skip)
            .select(*keep, "side", "segment", rest.alias("items")))

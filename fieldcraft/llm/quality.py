"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Words and adjacent word pairs are hashed into ``buckets``. Two multinomials
over the buckets are counted: the raw corpus (every document) and a trusted
target (every document labelled good). A document's score is the mean over its
n-grams of log p_target / p_raw; it is kept if the base rules pass and the score
is at least the cut, for every document alike.

The target multinomial is smoothed towards the raw one, with pseudo-counts in
proportion to the target (``SHARE`` of its n-grams, spread as the raw corpus
is), so that small and large tables weigh it alike. Every occurrence is left out
of the counts that it is scored with, so a document of the target and one
outside it score alike, in small tables too.

The cut is the score that ``KEEP`` of the documents labelled good reach, among
those that pass the base rules, all of them: their scores are written with the
counts and ordered in a distributed sort. Without any there is no cut.

Scale: the corpus is read once for counts (map-side combined, at most
``buckets`` rows leave a task) and once for scores, from which cut and verdicts
are read. The weights (``buckets`` doubles a table) are a scalar
subquery on a written row. A bitmap of fixed size tells which documents are
certainly not labelled good. Only the texts of the others are shuffled, once, for
the target's counts; a score needs no label: such documents get both scores, and
narrow rows (in ``keep_good``: the few rows whose two verdicts differ) are joined
with the labels. The plan is the same at every size.
DataFrame functions only.

Cases: null, empty and wordless texts have no words and fail the base rule;
a text without n-grams scores 0; documents without a label only count as raw;
repeated labels count once; repeated rows are judged separately; the columns of
the input pass through ``keep_good`` untouched, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcraft.functions.ordered import numbered
from fieldcraft.llm.membership import flag_likely
from fieldcraft.session import materialize

SPACE = " \t\n\x0b\x0c\r"
SPLIT = "[\\x20\\x09-\\x0D]+"
BUCKETS, SHARE, KEEP = 1 << 15, 0.05, 0.995
MIN_WORDS, MAX_REPEAT = 50, 50


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(bare) > 0, F.split(bare, SPLIT)).otherwise(F.array().cast("array<string>"))


def with_words(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``__words``, ``__hash`` (word hashes) and ``__pair`` (hashes of the
    adjacent word pairs)."""
    text, h = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.col("__hash")
    df = df.withColumn("__words", _words(text))
    df = df.withColumn("__hash", F.transform("__words", lambda w: F.xxhash64(w)))
    n = F.greatest(F.size(h) - 1, F.lit(0))
    return df.withColumn("__pair", F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(2), n),
                                              lambda a, b: F.xxhash64(a, b)))


def grams(buckets: int) -> Column:
    """Buckets of the words and of the adjacent word pairs."""
    bucket = lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    return F.concat(F.transform("__hash", bucket), F.transform("__pair", bucket))


def base_counts(df: DataFrame, text_col: str) -> DataFrame:
    """Adds the base counts to a table made by ``with_words``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    h, n = F.col("__hash"), F.greatest(F.size("__hash") - 2, F.lit(0))
    df = df.withColumn("__lines", F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0))
    df = df.withColumn("__tri", F.zip_with(F.slice("__pair", F.lit(1), n), F.slice(h, F.lit(3), n),
                                           lambda ab, c: F.xxhash64(ab, c)))
    # only texts with a repeated window sort their windows
    df = df.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__tri")) < F.size("__tri"),
        F.array_sort(F.transform("__tri", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    s = F.col("__sorted")
    same = lambda x, j: F.get(s, j)["x"] == x["x"]
    df = df.withColumn("__at", F.transform(
        F.filter(s, lambda x, j: F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False))),
        lambda x: x["i"]))
    covered = F.array_distinct(F.concat("__at", F.transform("__at", lambda p: p + 1),
                                        F.transform("__at", lambda p: p + 2)))
    return (df.withColumn("n_words", F.size("__words").cast("long"))
            .withColumn("word_chars", F.length(F.array_join("__words", "")).cast("long"))
            .withColumn("n_symbols", F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"))
            .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
            .withColumn("n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT))
            .drop("__lines", "__tri", "__sorted", "__at"))


def good_ids(labels: DataFrame) -> DataFrame:
    """``__good``: ids of the documents labelled good."""
    return (labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("__good"))
            .filter("__good IS NOT NULL").distinct())


def flag_good(rows: DataFrame, good: DataFrame) -> DataFrame:
    """Adds ``__in``: is the row's ``__id`` labelled good? Only rows that may be
    are shuffled."""
    near = flag_likely(rows, F.col("__id"), good)
    sure = near.filter("NOT __likely").drop("__likely").withColumn("__in", F.lit(False))
    return sure.unionByName(join_good(near.filter("__likely").drop("__likely"), good))


def join_good(rows: DataFrame, good: DataFrame) -> DataFrame:
    """Adds ``__in`` by a join of all rows; the same join at every size."""
    return (rows.join(good.hint("merge"), F.col("__id") == F.col("__good"), "left")
            .withColumn("__in", F.col("__good").isNotNull()).drop("__good"))


def weights(rows: DataFrame, buckets: int, prior: float | None = None) -> DataFrame:
    """log p_target / p_raw of every bucket, for occurrences outside and
    inside the target, as one row of two arrays; ``rows(__text, __in)``.
    ``prior``: pseudo-counts a bucket instead of ``SHARE`` of the target."""
    counts = (with_words(rows, "__text")
              .select(F.explode(grams(buckets)).alias("g"), F.col("__in").cast("int").alias("t"))
              .groupBy("g").agg(F.count("*").alias("r"), F.sum("t").alias("t")))
    got = {x["g"]: (x["r"], x["t"]) for x in counts.collect()}  # at most ``buckets`` rows
    raw, target = sum(r for r, _ in got.values()), sum(t for _, t in got.values())
    mass = SHARE * max(target, 1) if prior is None else prior * buckets
    outside, inside = [0.0] * buckets, [0.0] * buckets
    for g, (r, t) in got.items():
        if r > 1:
            p = (r - 1) / (raw - 1)
            outside[g] = math.log((t + mass * p) / ((target + mass) * p))
            inside[g] = math.log((max(t - 1, 0) + mass * p) / ((max(target - 1, 0) + mass) * p))
    return materialize(rows.sparkSession.createDataFrame(
        [(outside, inside)], "outside array<double>, inside array<double>"), "weights")


def with_ratio(df: DataFrame, name: str, tables: DataFrame, side: str, buckets: int,
               only: Column | None = None) -> DataFrame:
    """Adds ``name``: the mean of one side's weights over the n-grams of a row of
    ``with_words``; null where ``only`` does not hold."""
    n = F.size("__hash") + F.size("__pair")
    total = F.aggregate(F.concat("__hash", "__pair"), F.lit(0.0), lambda acc, h: acc + F.get(
        F.col("__table"), F.pmod(h, F.lit(buckets)).cast("int")))
    mean = F.when(n > 0, total / n).otherwise(F.lit(0.0))
    # the table is used once, so the optimizer puts the subquery's value there and
    # no row carries it
    return (df.withColumn("__table", tables.select(side).scalar())
            .select(*[c for c in df.columns if c != name], (mean if only is None else F.when(only, mean)).alias(name)))


def label_cut(scored: DataFrame, good: DataFrame) -> float:
    """The score that ``KEEP`` of all documents labelled good reach, among the rows
    ``scored(__id, __inside)`` that pass the base rules: the exact order statistic,
    by a distributed sort. Null ``__inside``: certainly not labelled good."""
    found = join_good(scored.select("__id", "__inside").filter("__inside IS NOT NULL"), good).filter("__in")
    # ids part equal scores, so that no task gets all of them
    placed, n = numbered(found.select("__inside", "__id"), ["__inside", "__id"], "__place")
    if not n:
        return -math.inf
    last = -(-n * round((1 - KEEP) * 1_000_000) // 1_000_000)  # rows up to the cut, rounded up
    return placed.filter(F.col("__place") == max(last, 1) - 1).first()["__inside"]


def _scored(rows: DataFrame, labels: DataFrame, buckets: int, prior: float | None) -> tuple[DataFrame, DataFrame]:
    """The rows with counts, ``__out`` (score of a document outside the target) and
    ``__inside`` (inside; null where it certainly is not), and the ids labelled good."""
    good = materialize(good_ids(labels), "good")
    tables = weights(flag_good(rows.select("__id", "__text"), good).select("__text", "__in"), buckets, prior)
    out = base_counts(with_words(flag_likely(rows, F.col("__id"), good), "__text"), "__text")
    out = with_ratio(out, "__out", tables, "outside", buckets)
    out = with_ratio(out, "__inside", tables, "inside", buckets, F.col("__likely"))
    # a filter on these columns would be pushed below them, with their whole
    # expressions inlined; that they ask for the row number keeps it here
    return out.withColumn("__at", F.monotonically_increasing_id()), good


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = BUCKETS, prior: float | None = None, threshold: float | None = None) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, llr`` per document."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    out, good = _scored(rows, labels, buckets, prior)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    # one narrow row a document, read for the cut and for the verdicts
    out = materialize(out.select("__id", *[F.when(F.col("__at") >= 0, F.col(c)).alias(c)
                                           for c in [*names, "__out", "__inside"]]), "scores")
    cut = label_cut(out.filter("NOT base_failed"), good) if threshold is None else threshold
    out = join_good(out, good).withColumn("llr", F.when(F.col("__in"), F.col("__inside")).otherwise(F.col("__out")))
    return out.select(F.col("__id").alias("doc_id"), *names,
                      (~F.col("base_failed") & (F.col("llr") >= cut)).alias("kept"), "llr")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              buckets: int = BUCKETS, prior: float | None = None, threshold: float | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns. Rows that pass
    whether they are labelled good or not are kept as they are; those for which it
    matters (their two scores lie on either side of the cut) are joined."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                         F.col(f"`{id_col}`").cast("long").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    out, good = _scored(packed, labels, buckets, prior)
    some = materialize(out.filter(~F.col("base_failed") & (F.col("__at") >= 0))
                       .select("__row", "__id", "__out", "__inside"), "unfailed")
    cut = label_cut(some, good) if threshold is None else threshold
    passes = F.col("__out") >= cut
    inside = F.coalesce(F.col("__inside") >= cut, passes)
    known = some.filter(passes & inside).select("__row.*")
    asked = join_good(some.filter(passes != inside).select("__row", "__id", inside.alias("__if_in")), good)
    return known.unionByName(asked.filter("__in = __if_in").select("__row.*"))

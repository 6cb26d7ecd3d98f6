"""File sources and sinks: profile log text, CSV with a fixed float format,
headerless score columns attached by position, glob scans of model outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcraft.functions.ordered import global_position
from fieldcraft.session import broadcast_if_small, materialize


# ------------------------------------------------------------------ S01
def write_profile_text(df: DataFrame, path: str, id_col: str = "uid",
                       fields: Sequence[str] = (), multi: Sequence[str] = (),
                       missing: str = "-1") -> None:
    """One line per user: ``uid 7|key v v|key v``; a null value, or a
    multi-valued cell equal to ``missing``, drops its key."""
    parts = [F.concat_ws(" ", F.lit(id_col), F.col(id_col).cast("string"))]
    for f in fields:
        v = F.col(f).cast("string")
        keep = v.isNotNull() & (v != F.lit(missing)) if f in multi else v.isNotNull()
        parts.append(F.when(keep, F.concat_ws(" ", F.lit(f), v)))
    df.select(F.concat_ws("|", *parts).alias("value")).write.mode("overwrite").text(path)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """Parse profile lines into ``profile MAP<STRING, ARRAY<STRING>>``:
    split on ``|``, each part on space, head = key, rest = values."""
    raw = spark.read.text(path)
    parts = F.transform(F.split(F.trim("value"), r"\|"), lambda p: F.split(p, " "))
    entries = F.transform(parts, lambda a: F.struct(a[0].alias("key"),
                                                    F.slice(a, 2, F.size(a)).alias("vals")))
    # a key that a line repeats keeps its last values
    last = F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return raw.select(F.map_from_entries(last).alias("profile"))


def profile_long(profile: DataFrame, id_key: str = "uid") -> DataFrame:
    """``(uid, key, vals)`` one row per non-id key, values joined by space."""
    return (profile.select(F.col("profile")[id_key][0].cast("long").alias(id_key),
                           F.explode("profile").alias("key", "v"))
                   .filter(F.col("key") != F.lit(id_key))
                   .select(id_key, "key", F.array_join("v", " ").alias("vals")))


def profile_max_len(profile: DataFrame) -> DataFrame:
    """``(key, max_len)`` = most values any user has for the key."""
    return (profile.select(F.explode("profile").alias("key", "v"))
                   .groupBy("key").agg(F.max(F.size("v")).cast("long").alias("max_len")))


def profile_wide(profile: DataFrame, keys: Sequence[str], id_key: str = "uid",
                 default: str = "0") -> DataFrame:
    """One column per key (``uid`` first, then sorted keys), values
    joined by space, absent key -> ``default``. Pure projection: no shuffle.
    ``keys`` is the column set (from :func:`profile_max_len`)."""
    ks = sorted(k for k in keys if k != id_key)
    cols = [F.col("profile")[id_key][0].cast("long").alias(id_key)]
    cols += [F.coalesce(F.array_join(F.col("profile")[k], " "), F.lit(default)).alias(k) for k in ks]
    return profile.select(*cols)


# ------------------------------------------------------------------ S03 / S05 / P14
def write_csv(df: DataFrame, path: str, float_format: str = "%.6f", label: str = "label") -> None:
    """CSV with header, columns sorted with the label last, doubles printed
    with a fixed format."""
    cols = sorted(c for c in df.columns if c != label) + ([label] if label in df.columns else [])
    out = []
    for c in cols:
        dt = df.schema[c].dataType
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            # a null stays an empty field
            out.append(F.when(F.col(c).isNotNull(), F.format_string(float_format, F.col(c))).alias(c))
        else:
            out.append(F.col(c))
    df.select(*out).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with header and explicit types (no inference). Columns are matched
    by header name, not position, then cast (a bad value fails under ANSI);
    optional subset."""
    raw = spark.read.option("header", True).csv(path)
    fields = [f for f in schema.fields if not columns or f.name in columns]
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])


# ------------------------------------------------------------------ S10 / J05
def file_order_columns() -> list[Column]:
    """Columns giving the line order of a text/CSV scan: folder, number of the
    part file, file name, split start, then the record number inside the task
    (monotonic id). The part number is compared as a number, so part-100000
    follows part-99999, and files of different folders do not interleave."""
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    number = F.regexp_extract(name, r"^\D*(\d{1,18})", 1).try_cast("bigint")
    return [F.regexp_replace(path, "[^/]*$", "").alias("_d"), F.coalesce(number, F.lit(-1)).alias("_n"),
            name.alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
            F.monotonically_increasing_id().alias("_m")]


def read_lines_with_position(spark: SparkSession, path: str, schema: T.StructType,
                             name: str = "pos", header: bool = False) -> DataFrame:
    """Read a headerless CSV and number its lines 0..n-1 in file order. The records
    are read and written once; each file split is counted, the counts are summed up
    over the splits before it (one row per split), and a record's number is its
    split's start plus its place there. Nothing is sorted but the splits."""
    df = spark.read.schema(schema).option("header", header).csv(path)
    by = ["_d", "_n", "_f", "_b"]
    # written, so both readers below see the same splits
    rows = materialize(df.select("*", *file_order_columns(), F.spark_partition_id().alias("_p")), "lines")
    splits = rows.groupBy(*by, "_p").agg(F.count(F.lit(1)).alias("_k"), F.min("_m").alias("_m0"))
    before = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)  # over splits, not records
    starts = splits.select("_p", "_b", F.xxhash64("_d", "_f").alias("_h"),
                           (F.coalesce(F.sum("_k").over(before), F.lit(0)) - F.col("_m0")).alias("_shift"))
    starts = materialize(starts, "splits")
    return (rows.withColumn("_h", F.xxhash64("_d", "_f")).join(broadcast_if_small(starts), ["_p", "_b", "_h"])
            .withColumn(name, (F.col("_m") + F.col("_shift")).cast("long"))
            .drop(*by, "_m", "_p", "_h", "_shift"))


def attach_by_position(ids: DataFrame, id_order: str, values: DataFrame,
                       value_pos: str = "pos") -> DataFrame:
    """Attach a row-aligned column: the i-th id row (in ``id_order``) gets
    the i-th value line. Both positions come from the distributed global
    position; the join is an equi-join on the position."""
    left = global_position(ids, [id_order], "_ipos")
    return left.join(values.withColumnRenamed(value_pos, "_ipos"), "_ipos").drop("_ipos")


# ------------------------------------------------------------------ S09
def read_model_outputs(spark: SparkSession, pattern: str, schema: T.StructType,
                       name_regex: str = r"model[^_/]*_([^/]+)/") -> DataFrame:
    """Glob scan of many score files (header, columns by name); the model
    name comes from the path."""
    raw = spark.read.option("header", True).csv(pattern)
    cols = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    return raw.select(*cols, F.regexp_extract(F.col("_metadata.file_path"), name_regex, 1).alias("model"))


# ------------------------------------------------------------------ S07
def write_ffm_text(lines: DataFrame, path: str, key: str | None = "row_id",
                   line: str = "line") -> None:
    """FFM text ``label field:idx:val ...``. With ``key`` each line is
    prefixed by ``key<TAB>`` so rows stay identifiable without relying on
    file order."""
    out = F.concat_ws("\t", F.col(key).cast("string"), F.col(line)) if key else F.col(line)
    lines.select(out.alias("value")).write.mode("overwrite").text(path)


def read_ffm_text(spark: SparkSession, path: str, keyed: bool = True,
                  labelled: bool = True) -> DataFrame:
    """Parse FFM text into ``(row_id, label, feats ARRAY<STRUCT<field INT,
    idx INT, val DOUBLE>>)``."""
    raw = spark.read.text(path)
    if keyed:
        kv = F.split("value", "\t", 2)
        raw = raw.select(kv[0].cast("long").alias("row_id"), kv[1].alias("value"))
    toks = F.filter(F.split("value", " "), lambda t: t != F.lit(""))
    lab = F.get(toks, 0).cast("int") if labelled else F.lit(None).cast("int")
    rest = F.slice(toks, 2, F.size(toks)) if labelled else toks
    feats = F.transform(rest, lambda e: F.struct(
        F.split(e, ":")[0].cast("int").alias("field"), F.split(e, ":")[1].cast("int").alias("idx"),
        F.split(e, ":")[2].cast("double").alias("val")))
    cols = (["row_id"] if keyed else [])
    return raw.select(*cols, lab.alias("label"), feats.alias("feats"))


# ------------------------------------------------------------------ S06 / S08 / S11 / S12
def write_feature_files(df: DataFrame, path: str, features: Sequence[str], split: str = "split",
                        row_id: str = "row_id") -> None:
    """One table per run with one column per feature, partitioned by split
    (the per-(split, feature) line files as a columnar layout)."""
    df.select(row_id, split, *features).write.mode("overwrite").partitionBy(split).parquet(path)


def read_feature_files(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(F.col("split") == split) if split else df  # partition pruning


def save_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Persist a vocabulary / count / matrix table (parquet or json)."""
    df.write.mode("overwrite").format(fmt).save(path)


def load_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.format(fmt)
    return (r.schema(schema) if schema is not None else r).load(path)


def materialize_once(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` unless ``path`` already holds it, then read it back: the
    written table cuts lineage and is reused by later jobs."""
    df.write.mode("ignore").parquet(path)
    return df.sparkSession.read.parquet(path)

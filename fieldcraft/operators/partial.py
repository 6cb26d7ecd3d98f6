"""Mergeable counts over arriving parts.

A store keeps, per statistic, how often each (key, item) has occurred: the exact
state of row counts, counts of non-null items and distinct counts at once. A new
part of the log is aggregated, merged with the stored state of the keys it touches
and written as a new version; the log of earlier parts is never read again, and of
the state only the key buckets that the part touches.

Layout below the store's path: ``data/v=<n>/bucket=<b>`` holds the buckets written
by version n, ``manifest/v=<n>`` says which version holds each bucket and which parts
are in. A manifest is written last, so a failed merge leaves the version before it
in force; a part that is already in is not counted twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcraft.functions.text import cross_key

STATE = T.StructType([T.StructField("stat", T.StringType()), T.StructField("key", T.StringType()),
                      T.StructField("item", T.StringType()), T.StructField("n", T.LongType()),
                      T.StructField("bucket", T.IntegerType())])
MANIFEST = "kind string, name string, version int"


@dataclass(frozen=True)
class Stat:
    """One statistic: the crossed ``keys`` and the column whose values are counted
    and told apart (none: rows only)."""
    name: str
    keys: tuple[str, ...]
    item: str | None = None


class CountStore:
    """Stored partial counts at ``path`` in shared storage."""

    def __init__(self, spark: SparkSession, path: str, stats: Sequence[Stat], buckets: int = 64) -> None:
        self.spark, self.path, self.stats, self.buckets = spark, path.rstrip("/"), list(stats), buckets

    # -------------------------------------------------------------- manifest
    def version(self) -> int:
        """Number of the latest whole version, 0 for an empty store."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        fs = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(fs_path):
            return 0
        done = [int(s.getPath().getName()[2:]) for s in fs.listStatus(fs_path)
                if s.getPath().getName().startswith("v=")
                and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return max(done, default=0)

    def manifest(self) -> tuple[dict[int, int], list[str]]:
        """Version of each written bucket (at most ``buckets``), and the parts in."""
        at = self.version()
        if not at:
            return {}, []
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/v={at}").collect()
        return ({int(r["name"]): r["version"] for r in rows if r["kind"] == "bucket"},
                [r["name"] for r in rows if r["kind"] == "part"])

    # -------------------------------------------------------------- state
    def _aggregate(self, part: DataFrame) -> DataFrame:
        """State rows of a part, every statistic stacked into one aggregation."""
        rows = F.array(*[F.struct(F.lit(s.name).alias("stat"), cross_key(*s.keys).alias("key"),
                                  (F.col(s.item).cast("string") if s.item else F.lit(None).cast("string")).alias("item"))
                         for s in self.stats])
        return (part.select(F.explode(rows).alias("e")).select("e.*")
                .groupBy("stat", "key", "item").agg(F.count(F.lit(1)).alias("n"))
                .withColumn("bucket", F.pmod(F.xxhash64("stat", "key"), F.lit(self.buckets)).cast("int")))

    def _read(self, held: dict[int, int], only: set[int] | None = None) -> DataFrame:
        """The stored rows of the buckets ``only`` (all without)."""
        by: dict[int, list[int]] = {}
        for bucket, v in held.items():
            if only is None or bucket in only:
                by.setdefault(v, []).append(bucket)
        out = self.spark.createDataFrame([], STATE)
        for v, some in sorted(by.items()):
            out = out.unionByName(self.spark.read.schema(STATE).parquet(f"{self.path}/data/v={v}")
                                  .filter(F.col("bucket").isin(some)))  # partition pruning
        return out

    def state(self) -> DataFrame:
        """``stat, key, item, n`` of all parts."""
        return self._read(self.manifest()[0]).drop("bucket")

    def absorb(self, part: DataFrame, name: str) -> bool:
        """Merge a part under its name; False if it is in already."""
        held, parts = self.manifest()
        if name in parts:
            return False
        new = self._aggregate(part)
        at = self.version() + 1
        # the part's own counts first, so it is read once; its buckets are at most ``buckets``
        new.write.mode("overwrite").parquet(f"{self.path}/arrived/v={at}")
        new = self.spark.read.schema(STATE).parquet(f"{self.path}/arrived/v={at}")
        touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}
        merged = (self._read(held, touched).unionByName(new).groupBy("stat", "key", "item", "bucket")
                  .agg(F.sum("n").alias("n")))
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/v={at}")
        held = held | {b: at for b in touched}
        rows = [("bucket", str(b), v) for b, v in held.items()] + [("part", p, at) for p in [*parts, name]]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={at}")
        return True

    # -------------------------------------------------------------- results
    def counts(self) -> DataFrame:
        """``stat, key, n_rows, n_items, n_distinct``: rows, non-null items and
        different items of each key over all parts."""
        known = F.col("item").isNotNull()
        return self.state().groupBy("stat", "key").agg(
            F.sum("n").alias("n_rows"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n_items"),
            F.count("item").alias("n_distinct"))

    def attach(self, df: DataFrame, stat: Stat, value: str, name: str) -> DataFrame:
        """``df`` with one result of its rows' keys; 0 for a key never seen."""
        table = self.counts().filter(F.col("stat") == stat.name).select(F.col("key").alias("_key"), F.col(value).alias(name))
        return (df.join(table, cross_key(*stat.keys) == F.col("_key"), "left").drop("_key")
                .withColumn(name, F.coalesce(name, F.lit(0))))

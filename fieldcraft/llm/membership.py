"""Joins of wide rows with an id table of which few rows take part.

The ids are folded into a bitmap of fixed size (``BITS`` bits, 2 MB), the only
thing broadcast. Rows whose bit is clear are certainly not among the ids and
stay where they are; only the others are joined. A full bitmap only means that
more rows are joined; results never change. The join hashes a partition's part
of the narrow table, so the wide rows pass by and are never sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, PER_MAP = 1 << 24, 1 << 15
_COLS = ["__spot", "__map", "__bits"]


def _spot(key: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(11), key), F.lit(BITS))


def flag_likely(rows: DataFrame, key: Column, ids: DataFrame, name: str = "__likely") -> DataFrame:
    """Adds ``name``: false where ``key`` is certainly not in the one column of
    ``ids``."""
    spot = _spot(F.col(f"`{ids.columns[0]}`"))
    maps = (ids.select(F.floor(spot / PER_MAP).cast("int").alias("__map"), (spot % PER_MAP).alias("__bit"))
            .groupBy("__map").agg(F.bitmap_construct_agg("__bit").alias("__bits")))
    at = F.col("__spot") % PER_MAP
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.when((at % 8) == 0, F.lit(1))
    for k in range(1, 8):
        bit = bit.when((at % 8) == k, F.lit(1 << k))
    return (rows.withColumn("__spot", _spot(key)).withColumn("__map", F.floor(F.col("__spot") / PER_MAP).cast("int"))
            .join(F.broadcast(maps), "__map", "left")
            .withColumn(name, F.coalesce(byte.bitwiseAND(bit) > 0, F.lit(False))).drop(*_COLS))


def rows_of(rows: DataFrame, key: str, table: DataFrame, table_key: str) -> DataFrame:
    """Inner join of ``rows`` with ``table`` on their keys."""
    near = flag_likely(rows, F.col(f"`{key}`"), table.select(table_key).distinct()).filter("__likely").drop("__likely")
    return near.join(table.hint("shuffle_hash"), F.col(f"`{key}`") == F.col(f"`{table_key}`"))


def rows_without(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose key is not in the one column of ``ids``; null keys stay. The
    columns travel in a struct, whatever their names."""
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.col(f"`{key}`").alias("key"))
    ids = ids.select(F.col(f"`{ids.columns[0]}`").alias("gone")).distinct()
    flagged = flag_likely(packed, F.col("key"), ids)
    sure = flagged.filter("NOT __likely").select("row.*")
    rest = (flagged.filter("__likely").join(ids.hint("shuffle_hash"), F.col("key") == F.col("gone"), "left_anti")
            .select("row.*"))
    return sure.unionByName(rest)


def bound_batches(spark, rows: int = 1000) -> None:
    """Let Arrow batches hold at most ``rows`` rows in this session: batches of
    whole texts then stay a few MB in the JVM and in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))

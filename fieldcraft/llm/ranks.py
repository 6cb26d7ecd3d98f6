"""Global positions without a single sorting task (DataFrame only).

Rows are range-partitioned and sorted, numbered inside their partition and
written; the counts of the partitions (one row each) are summed up by a window
and broadcast as offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcraft.session import materialize


def positions(df: DataFrame, order: Sequence[Column | str], name: str = "pos") -> tuple[DataFrame, int]:
    """``df`` (written to the shared folder) with its 0-based position in
    ``order``, and its number of rows. Rows equal in ``order`` get an arbitrary
    order that is fixed once written."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "positions")
    counts = numbered.groupBy("__part").agg(F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    table = F.broadcast(counts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base")))
    return (numbered.join(table, "__part")
            .withColumn(name, F.col("__base") + F.col("__at")).drop("__part", "__at", "__base")), numbered.count()

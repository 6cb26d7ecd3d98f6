"""Order-dependent helpers that never move a whole table into one task.

A window without ``partitionBy`` sends every row to one task. Instead:

1. range-partition on the order columns and sort inside each partition;
2. ``checkpoint()`` the result into ``spark.checkpoint.dir`` so both passes
   below see the same partition boundaries (and survive executor loss);
3. take one small row per partition (its row count or value sums), prefix-sum
   those on the driver - bounded by the number of partitions, not by rows;
4. add the partition's offset to the position / running sum inside the task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcraft.session import ensure_checkpoint_dir

_PID = "__pid"
_MID = "__mid"


def _n_parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sorted_checkpoint(df: DataFrame, order: Sequence[Column | str],
                      num_partitions: int | None = None) -> DataFrame:
    """Range-partition + sort within partitions, materialised reliably."""
    ensure_checkpoint_dir(df.sparkSession)
    n = _n_parts(df, num_partitions)
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)


def _offsets(counts: dict[int, float], n: int) -> list:
    out, acc = [], 0
    for p in range(n):
        out.append(acc)
        acc += counts.get(p, 0)
    return out


def global_position(df: DataFrame, order: Sequence[Column | str], name: str = "pos",
                    num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based contiguous position in ``order`` (ties in an arbitrary
    but fixed order). JVM-only: ``monotonically_increasing_id`` carries the
    record number inside its partition."""
    return numbered(df, order, name, num_partitions)[0]


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "pos",
             num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """:func:`global_position` and the number of rows, both from the one count
    per partition."""
    srt = sorted_checkpoint(df, order, num_partitions)
    nparts = srt.rdd.getNumPartitions()
    counts = {r[0]: r[1] for r in
              srt.groupBy(F.spark_partition_id()).count().collect()}  # <= nparts rows
    offs = _offsets(counts, nparts)
    pid = F.spark_partition_id()
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    # one constant, however many partitions there are
    table = F.split(F.lit(",".join(str(int(o)) for o in offs) or "0"), ",").cast("array<bigint>")
    return srt.withColumn(name, F.element_at(table, pid + 1) + local), int(sum(counts.values()))


def global_prefix_sum(df: DataFrame, order: Sequence[Column | str], values: Sequence[str],
                      names: Sequence[str], inclusive: bool = False,
                      num_partitions: int | None = None) -> DataFrame:
    """Running sums of ``values`` in ``order`` across the whole table.
    ``inclusive=False`` gives the sum over strictly earlier rows."""
    srt = sorted_checkpoint(df, order, num_partitions)
    nparts = srt.rdd.getNumPartitions()
    sums = (srt.groupBy(F.spark_partition_id().alias(_PID))
               .agg(*[F.sum(v).alias(v) for v in values]).collect())  # <= nparts rows
    offs = {v: _offsets({r[_PID]: (r[v] or 0) for r in sums}, nparts) for v in values}
    schema = T.StructType(list(srt.schema.fields)
                          + [T.StructField(nm, T.DoubleType()) for nm in names])
    cols = list(values)

    def run(batches):
        from pyspark import TaskContext
        p = TaskContext.get().partitionId()
        acc = {v: float(offs[v][p]) for v in cols}
        for pdf in batches:
            for v, nm in zip(cols, names):
                x = pdf[v].to_numpy(dtype="float64", na_value=0.0)
                cs = np.cumsum(x)
                pdf[nm] = acc[v] + (cs if inclusive else cs - x)
                acc[v] += float(cs[-1]) if len(cs) else 0.0
            yield pdf

    return srt.mapInPandas(run, schema)


def dense_index(df: DataFrame, cols: Sequence[str], name: str = "idx",
                num_partitions: int | None = None) -> DataFrame:
    """Distinct values of ``cols`` numbered 0..n-1 in ascending order."""
    return global_position(df.select(*cols).distinct(), list(cols), name, num_partitions)


__all__ = ["sorted_checkpoint", "global_position", "numbered", "global_prefix_sum", "dense_index"]

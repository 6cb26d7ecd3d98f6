"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "fieldcraft", extra: dict | None = None) -> SparkSession:
    """Session for tests and local benches. On a cluster, use the cluster's
    own session; every operator only needs ``spark.checkpoint.dir``."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("FIELDCRAFT_DRIVER_MEM", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), for sessions
    whose Python workers do not find it by themselves."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="fieldcraft-zip-"), "fieldcraft.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Only when it is unset and the master is local (tests) is a private folder
    under /tmp made; on a cluster that folder would differ from machine to
    machine, so there the missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = private_folder(sc.master)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def private_folder(master: str) -> str:
    """A machine-local folder, for local masters only."""
    if not master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir is not set; on a cluster it must name a "
                           "folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="fieldcraft-ckpt-", dir="/tmp")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/fieldcraft-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    the lineage, survives lost executors, and is read by column. ``group_rows``: rows
    of a row group, for tables whose rows take megabytes; a reader holds up to 4096
    rows of a group at once."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Delete the files of a table made by ``materialize`` that nothing reads
    any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if folder.getName().startswith("fieldcraft-"):
            drop_folder(spark, folder.toString())


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: off)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    m = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    raw = raw.strip().lower().rstrip("b")
    return int(float(raw[:-1]) * m[raw[-1]]) if raw and raw[-1] in m else int(raw)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``, counted (one aggregate): the lengths of
    string and binary values, 16 bytes for any other value and per row."""
    sized = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
             if isinstance(f.dataType, (T.StringType, T.BinaryType))
             else F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))))
             if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.lit(16)
             for f in df.schema.fields]
    total = sum((c.cast("long") for c in sized), F.lit(16).cast("long"))
    return int(df.agg(F.sum(total)).first()[0] or 0)


def broadcast_if_small(df: DataFrame, rows: int | None = None, row_bytes: int = 64) -> DataFrame:
    """``broadcast(df)`` when the measured size of its rows fits under
    ``spark.sql.autoBroadcastJoinThreshold``; otherwise the plain table (Spark
    shuffles it, or AQE broadcasts it from its run-time size). ``rows`` and
    ``row_bytes`` skip the measuring of a table that is too large anyhow."""
    limit = broadcast_limit(df.sparkSession)
    if limit < 0 or (rows is not None and rows * 16 > limit):
        return df
    return F.broadcast(df) if measured_bytes(df) <= limit else df

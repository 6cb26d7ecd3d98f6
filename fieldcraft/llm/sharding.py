"""Shards that all match the source mixture, by stratified interleaving.

Rows are shuffled by a seeded hash inside each source and ranked; the rank
divided by the source's size is a fraction between 0 and 1. In the order of
these fractions every source is spread evenly, so equal cuts of that order give
shards of equal row counts (at most one apart, the ``rows`` law) that each hold
their share of every source.

Scale: two range sorts of narrow rows (no texts) give both ranks; no window
over a source, so a source with a third of all rows is sorted by all tasks. The
table of sources is broadcast only if its measured size allows it.

Cases: a null source is a source of its own; null text has size 1 and the
CRC-32 of nothing; repeated rows are placed separately; an empty table gives an
empty result; other columns are ignored. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.llm.ranks import positions
from fieldcraft.session import broadcast_if_small

SHARDS, SEED = 16, "fieldcraft"


def interleave(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", seed: str = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, source``."""
    text = F.col(f"`{text_col}`")
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.col(f"`{source_col}`").alias("source"))
    rows = rows.withColumn("key", F.md5(F.concat_ws("/", F.lit(seed), F.col("doc_id")).cast("binary")))
    unique = ["key", "doc_id", "text_crc32", "size"]
    ranked, total = positions(rows, ["source", *unique], "rank")
    strata = (ranked.groupBy("source").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
              .withColumnRenamed("source", "stratum"))
    spread = (ranked.join(broadcast_if_small(strata), F.col("source").eqNullSafe(F.col("stratum")))
              .withColumn("fraction", (F.col("rank") - F.col("first") + 0.5) / F.col("n"))
              .drop("rank", "first", "n", "stratum"))
    placed, total = positions(spread, ["fraction", "source", *unique], "pos")
    n = max(total, 1)
    return (placed.withColumn("shard", F.expr(f"CAST((pos * {shards}L) DIV {n}L AS INT)"))
            .withColumn("slot", F.col("pos") - F.expr(f"(shard * {n}L + {shards - 1}) DIV {shards}"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "source"))

"""Sparse rows without a driver vocabulary.

Categorical columns become one-hot entries, multi-valued columns bags of tokens
(runs of letters, digits and underscores, lower-cased, kept if at least ``min_df``
training rows hold them), numeric columns entries of their own. The vocabulary is a
table ``(field, value, idx)``: numeric columns first, then the fields in the given
order, each one's values in ascending order; its positions come from the
distributed numbering, so nothing on the driver grows with it.

Encoded rows are stored as blocks: one CSR row ``(block, row_ids, indptr, indices,
vals)`` per hash block of the row id, made in one grouping. Blocks are a plain
table: they can be written, read in a later session, taken apart into rows or
into vectors of Spark ML, or handed whole to array code.

Cases: null categories and unknown values give no entry; an empty or null cell
gives no tokens; a null number gives none, zero neither; repeated tokens add up;
every row keeps its place even without entries; row ids must be unique.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcraft.functions.ordered import global_position
from fieldcraft.operators.encode import FieldSpec, vocab_side
from fieldcraft.session import scratch_path

#: a token: letters, digits and underscores
WORD = r"([\p{L}\p{N}_]+)"
BLOCKS = "block long, row_ids array<long>, indptr array<long>, indices array<long>, vals array<double>"


def words(cell: str | Column) -> Column:
    """Lower-cased tokens of a cell; an empty array for null."""
    col = F.col(f"`{cell}`") if isinstance(cell, str) else cell
    return F.coalesce(F.regexp_extract_all(F.lower(col), F.lit(WORD), F.lit(1)), F.array().cast("array<string>"))


def _by_kind(specs: Sequence[FieldSpec]) -> tuple[list[FieldSpec], list[FieldSpec]]:
    return [s for s in specs if s.kind == "continuous"], [s for s in specs if s.kind != "continuous"]


def _named(field: str):
    return lambda t: F.struct(F.lit(field).alias("field"), t.alias("value"))


def _values(df: DataFrame, specs: Sequence[FieldSpec], keep: Sequence[str], distinct: bool = False) -> DataFrame:
    """``keep + (field, value)``: one row per category and token; ``distinct``
    leaves out repeats inside a cell."""
    entries = []
    for s in specs:
        if s.kind == "multi":
            toks = words(s.name)
            toks = F.array_distinct(toks) if distinct else toks
        else:
            value = F.col(f"`{s.name}`").cast("string")
            toks = F.when(value.isNotNull(), F.array(value)).otherwise(F.array().cast("array<string>"))
        entries.append(F.transform(toks, _named(s.name)))
    return df.select(*keep, F.explode(F.concat(*entries)).alias("_e")).select(*keep, "_e.field", "_e.value")


def fit_vocabulary(train: DataFrame, specs: Sequence[FieldSpec], min_df: int = 5) -> DataFrame:
    """``(field, value, df, idx)`` of the training rows, numeric columns first
    (their value is null)."""
    spark = train.sparkSession
    numeric, other = _by_kind(specs)
    order = F.create_map(*[x for i, s in enumerate(other) for x in (F.lit(s.name), F.lit(i))])
    multi = [s.name for s in other if s.kind == "multi"]
    counts = _values(train, other, (), distinct=True).groupBy("field", "value").agg(F.count("*").alias("df"))
    if multi:
        counts = counts.filter(~F.col("field").isin(*multi) | (F.col("df") >= min_df))
    placed = global_position(counts.withColumn("_f", F.element_at(order, F.col("field"))), ["_f", "value"], "_at")
    table = placed.select("field", "value", "df", (F.col("_at") + len(numeric)).cast("long").alias("idx"))
    head = [(s.name, None, None, i) for i, s in enumerate(numeric)]
    return spark.createDataFrame(head, "field string, value string, df long, idx long").unionByName(table)


def size(vocab: DataFrame) -> int:
    """Width of the encoded rows."""
    return int(vocab.agg(F.coalesce(F.max("idx") + 1, F.lit(0))).first()[0])


def entries(df: DataFrame, specs: Sequence[FieldSpec], vocab: DataFrame, row_id: str = "row_id") -> DataFrame:
    """``(row_id, idx, val)``: one row per value known to the vocabulary."""
    numeric, other = _by_kind(specs)
    known = vocab_side(vocab.filter("value IS NOT NULL").select("field", "value", "idx"))
    out = (_values(df, other, (row_id,)).join(known, ["field", "value"])
           .select(row_id, "idx", F.lit(1.0).alias("val")))
    if numeric:
        cells = F.array(*[F.struct(F.lit(i).cast("long").alias("idx"), F.col(f"`{s.name}`").cast("double").alias("val"))
                          for i, s in enumerate(numeric)])
        nums = df.select(row_id, F.explode(cells).alias("_e")).select(row_id, "_e.idx", "_e.val")
        out = out.unionByName(nums.filter("val IS NOT NULL AND val <> 0"))
    return out


#: rows that one block, so one array task, holds at most on average
BLOCK_ROWS = 20_000


def n_blocks(df: DataFrame, least: int = 1) -> int:
    """Blocks for the rows of ``df``: as many as keep each at ``BLOCK_ROWS``."""
    return max(least, -(-df.count() // BLOCK_ROWS))


def to_blocks(df: DataFrame, found: DataFrame, n_blocks: int, row_id: str = "row_id") -> DataFrame:
    """CSR blocks of the rows of ``df`` and their ``found(row_id, idx, val)``;
    equal indices of a row are added up. One grouping on the block."""
    both = (found.select(F.col(row_id).alias("row_id"), "idx", "val")
            .unionByName(df.select(F.col(row_id).alias("row_id"), F.lit(None).cast("long").alias("idx"),
                                   F.lit(None).cast("double").alias("val"))))
    both = both.withColumn("block", F.pmod(F.xxhash64("row_id"), F.lit(n_blocks)).cast("long"))

    def build(table):
        import pyarrow as pa
        idx = np.asarray(table.column("idx").fill_null(-1))
        ident = np.asarray(table.column("row_id"))
        ids = np.unique(ident[idx < 0])
        mine = np.flatnonzero(idx >= 0)
        row, idx = np.searchsorted(ids, ident[mine]), idx[mine]
        val = np.asarray(table.column("val").fill_null(0.0))[mine]
        order = np.lexsort((idx, row))
        row, idx, val = row[order], idx[order], val[order]
        if len(row):
            edge = np.flatnonzero(np.concatenate(([True], (np.diff(row) != 0) | (np.diff(idx) != 0))))
            row, idx, val = row[edge], idx[edge], np.add.reduceat(val, edge)
        cols = [[int(table.column("block")[0].as_py())], [ids], [np.searchsorted(row, np.arange(len(ids) + 1))], [idx], [val]]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64())]
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in BLOCKS.split(", ")])

    return both.groupBy("block").applyInArrow(build, BLOCKS)


def encode_blocks(df: DataFrame, specs: Sequence[FieldSpec], vocab: DataFrame, n_blocks: int,
                  row_id: str = "row_id") -> DataFrame:
    """Encoded rows of ``df`` as CSR blocks."""
    cols = [row_id, *[f"`{s.name}`" for s in specs]]
    return to_blocks(df, entries(df.select(*cols), specs, vocab, row_id), n_blocks, row_id)


def block_rows(blocks: DataFrame) -> DataFrame:
    """Blocks taken apart: ``row_id, indices, vals``; a block's arrays become
    lists by its row pointers, without a loop over rows."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for b in range(batch.num_rows):
                ids, indptr, idx, val = (batch.column(c)[b].values for c in ("row_ids", "indptr", "indices", "vals"))
                cut = indptr.cast(pa.int32())
                yield pa.record_batch([ids, pa.ListArray.from_arrays(cut, idx), pa.ListArray.from_arrays(cut, val)],
                                      ["row_id", "indices", "vals"])

    return blocks.select(*[f.split()[0] for f in BLOCKS.split(", ")]).mapInArrow(
        run, "row_id long, indices array<long>, vals array<double>")


def block_vectors(blocks: DataFrame, width: int, name: str = "features") -> DataFrame:
    """``row_id, features``: sparse vectors of Spark ML. Their fields are written as
    Parquet and read with the vector type, without a loop over rows."""
    spark, path = blocks.sparkSession, scratch_path(blocks.sparkSession, "vectors")
    vec = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(width).cast("int").alias("size"),
                   F.col("indices").cast("array<int>").alias("indices"), F.col("vals").alias("values"))
    block_rows(blocks).select("row_id", vec.alias(name)).write.parquet(path)
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField(name, VectorUDT())])
    return spark.read.schema(schema).parquet(path)

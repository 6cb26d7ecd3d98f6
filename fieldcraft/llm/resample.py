"""Target-distribution importance resampling over hashed word features.

Features are the words of a text and its pairs of adjacent words. In tasks, Arrow
kernels lower-case a batch, split it, flatten the lists and dictionary-encode the
words; neighbouring dictionary indices form the pairs, each *distinct* word or
pair of a batch is hashed once by CRC-32 and its bucket is taken for every
occurrence. Bucket counts of the raw table and of the target give a gain per
bucket, the floored log ratio of their smoothed shares; a document's weight is
the floored mean gain of its features (one segment sum per batch). Gumbel noise
from a hash of the id is added, and the highest scores are drawn: sampling
without replacement in proportion to exp(weight).

Scale: the texts are read twice and never shuffled. A counting task hands on at
most ``buckets`` rows; the gains (``buckets`` numbers) are all the driver and the
tasks share. The draw is a range sort of narrow rows with positions.

Cases: null and wordless texts have no features and weight 0; a text of any
length is split whole; an empty target or raw table leaves the smoothing alone;
a null id hashes as an empty one and comes last among ties; repeated rows are
drawn separately; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.llm.membership import bound_batches
from fieldcraft.llm.ranks import positions
from fieldcraft.session import materialize

BUCKETS, MIN_WORDS, SHARE, SEED = 10_000, 20, 25, 7
#: what separates words: ASCII other than digits and lower-case letters
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: texts handled at a time: rows, and bytes after which a group ends
GROUP_ROWS, GROUP_BYTES = 512, 4 << 20


def words(texts):
    """``(words, owners)``: the words of an Arrow array of texts, flattened, and
    the row of each."""
    import pyarrow.compute as pc
    lists = pc.split_pattern_regex(pc.fill_null(pc.ascii_lower(texts), ""), BREAK)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)  # a text may begin or end with a break
    return flat.filter(real), np.asarray(owner.filter(real), np.int64)


def features(texts, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word its bucket; per pair of neighbours in a row its first word's
    place and its bucket; the owners of the words."""
    import pyarrow.compute as pc
    flat, owner = words(texts)
    coded = pc.dictionary_encode(flat)
    index = np.asarray(coded.indices, np.int64)
    names = [w.encode() for w in coded.dictionary.to_pylist()]
    crc = np.array([zlib.crc32(w) for w in names], np.int64)
    at = np.flatnonzero(owner[1:] == owner[:-1])
    codes, place = np.unique(index[at] * max(len(names), 1) + index[at + 1], return_inverse=True)
    left, right = np.divmod(codes, max(len(names), 1))
    # a pair's CRC-32 goes on from its first word's
    pair = np.array([zlib.crc32(b" " + names[b], c) for c, b in zip(crc[left].tolist(), right.tolist())], np.int64)
    return crc[index] % buckets, at, (pair % buckets)[place], owner


def _groups(batches):
    """Slices of (id, text) batches of bounded rows and bytes."""
    import pyarrow.compute as pc
    for batch in batches:
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0), np.int64))
        at = 0
        while at < batch.num_rows:
            base = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, base + GROUP_BYTES, "right")))
            end = min(end, at + GROUP_ROWS, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the table fall into each bucket."""
    bound_batches(df.sparkSession)

    def run(batches):
        import pyarrow as pa
        total = np.zeros(buckets, np.int64)
        for part in _groups(batches):
            one, _, two, _ = features(part.column(1), buckets)
            total += np.bincount(one, minlength=buckets) + np.bincount(two, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    rows = df.select(F.lit(0).alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(smoothed target share / smoothed raw share)) per bucket."""
    k, s, t = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + k) / ((a + 1.0) * (t + k))))
                     for a, b in zip(raw.tolist(), target.tolist())], np.int64)


def weigh(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` per row."""
    bound_batches(df.sparkSession)

    def run(batches):
        import pyarrow as pa
        for part in _groups(batches):
            one, at, two, owner = features(part.column(1), len(gain))
            rows = part.num_rows
            n_words = np.bincount(owner, minlength=rows)
            n = n_words + np.bincount(owner[at], minlength=rows)
            # gains by document: a pair follows its first word
            value = gain[one].copy()
            value[at] += gain[two]
            edge = np.concatenate(([0], np.cumsum(n_words)))
            run_sum = np.concatenate(([0], np.cumsum(value)))
            total = run_sum[edge[1:]] - run_sum[edge[:-1]]
            yield pa.record_batch([part.column(0), pa.array(n_words), pa.array(n),
                                   pa.array(total // np.maximum(n, 1))],
                                  ["doc_id", "n_words", "n_features", "weight"])

    return (df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", buckets: int = BUCKETS, min_words: int = MIN_WORDS,
             share: int = SHARE, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` per document; ``rank`` numbers
    the drawn ``share`` percent of the documents with at least ``min_words``."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = materialize(weigh(docs, gain, id_col, text_col)
                         .withColumn("score", F.col("weight") + noise.cast("long")), "scored")
    names = ["doc_id", "n_features", "weight", "score"]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    placed, n = positions(scored.filter(F.col("n_words") >= min_words).select(*names), order)
    rank = F.when(F.col("pos") < share * n // 100, F.col("pos") + 1).cast("long")
    rest = scored.filter(F.col("n_words") < min_words).select(*names, F.lit(None).cast("long").alias("rank"))
    return placed.select(*names, rank.alias("rank")).unionByName(rest)

"""Alignment of two tokenizers' tokens over the bytes of the same texts.

A is a byte-level BPE of the tokenizers library's files, B a sentencepiece model
that puts a space before a text, so A reads the space too. Each token is an
interval of the text's bytes. The intervals of both sides of a batch of texts
(laid end to end) are sorted together by start; the running maximum of their ends
breaks the order into groups wherever a start reaches it, i.e. where both sides
end a token. Inside the groups every A token is expanded into the B tokens that
its interval overlaps: the links. How often an id pair is linked in all texts is
then counted, and every document gets the number of its links whose pair is the
commonest of its B id, and the sum of its links' counts.

Long texts are encoded in pieces cut before a single space between other
characters. A's pattern always cuts there; B does if none of its vocabulary's
pieces holds a space after another character and it does not rewrite texts,
else its texts stay whole. Tokens of both sides end at such a cut, so it changes
no group.

Scale: texts are read once and never shuffled; what is written per document is
its distinct pairs. Pair counts combine in the tasks first. Looking them up would
shuffle those pairs by key, with pairs that every document holds: so the
commonest pairs (at most ``HOT``, by a cut on their counts; a few MB) are
broadcast, and only documents' rarer pairs are joined by key. Documents are
grouped by a row number.

Cases: null and empty texts, and those whose joined A or B bytes are not the
space and the text, have no tokens: zeros and an empty ``groups_sha256``; very
long texts give one row as others; repeated rows count separately; null ids pass
through; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.llm.membership import bound_batches
from fieldcraft.llm.packing import Ranks
from fieldcraft.session import materialize

#: pairs broadcast at most; characters of texts encoded together
HOT, GROUP_CHARS = 1 << 17, 1 << 18

_CUT = re.compile(r"(?<=\S)(?= \S)")
_OWN = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
DOCS = _OWN + ", pairs array<long>, times array<int>"


def coalesce(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every A and every B token, for tokens that cover the same
    bytes without gaps and end there."""
    starts = np.concatenate(([0], ends_a[:-1], [0], ends_b[:-1]))
    ends = np.concatenate((ends_a, ends_b))
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    new = np.concatenate(([0], starts[order][1:] >= reach[:-1]))
    group = np.empty(len(ends), np.int64)
    group[order] = np.cumsum(new)
    return group[:len(ends_a)], group[len(ends_a):]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of an A and a B token (by place) whose bytes overlap."""
    starts_a, starts_b = np.concatenate(([0], ends_a[:-1])), np.concatenate(([0], ends_b[:-1]))
    first = np.searchsorted(ends_b, starts_a, "right")
    many = np.searchsorted(starts_b, ends_a, "left") - first
    a = np.repeat(np.arange(len(ends_a)), many)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(many) - many - first, many)


def _groups_text(names: np.ndarray, ids: np.ndarray, side: np.ndarray, group: np.ndarray, owner: np.ndarray,
                 rows: int) -> list[bytes]:
    """Per row ``a1,a2|b1;a3|b2``; ``names``: texts of the ids."""
    order = np.lexsort((side, group))
    ids, side, group, owner = ids[order], side[order], group[order], owner[order]
    mark = np.full(len(ids), 0)
    mark[:-1] = np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
    parts = names[mark, ids].tolist()
    edge = np.searchsorted(owner, np.arange(rows + 1))
    return [b"".join(parts[a:b])[:-1] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


class Aligner:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_file: str, pattern: str, b_model: bytes) -> None:
        import sentencepiece
        self.a = Ranks(a_file, pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_bytes = self.a.pieces
        self.a_len, self.b_len = (np.array([len(p) for p in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.width = len(self.b_bytes)
        probe = "ﬁ Å  \t　x  "  # a rewriting model changes some of this
        self.cuts = (not any(re.search("[^▁]▁", p) for p in pieces)
                     and self._bytes_b(self.b.encode(probe)) == (" " + probe).encode())
        most = max(len(self.a_bytes), self.width)
        self.names = np.array([[f"{i}{mark}".encode() for i in range(most)] for mark in ",|;"], object)

    def _bytes_b(self, ids: list[int]) -> bytes:
        return b"".join([self.b_bytes[i] for i in ids])

    def pieces(self, text: str) -> list[str]:
        """A long text in pieces of about ``GROUP_CHARS``."""
        if not self.cuts or len(text) <= GROUP_CHARS:
            return [text]
        out, at = [], 0
        while at < len(text):
            m = _CUT.search(text, at + GROUP_CHARS)
            end = m.start() if m else len(text)
            out.append(text[at:end])
            at = end
        return out

    def encode(self, piece: str, first: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """A and B ids of a piece, None if either side's bytes differ. The first
        piece of a text gets the space before; others begin with their own."""
        whole = " " + piece if first else piece
        raw = whole.encode()
        a, b = self.a.encode(whole), self.b.encode(whole[1:], num_threads=1)
        if b"".join([self.a_bytes[i] for i in a.tolist()]) != raw or self._bytes_b(b) != raw:
            return None
        return a.astype(np.int64), np.array(b, np.int64)

    def align(self, tokens: list[tuple[np.ndarray, np.ndarray]]) -> dict:
        """Tokens of several texts -> per text the counts, the group text and its
        distinct pairs with how often they are linked (one flat list)."""
        rows = len(tokens)
        a, b = (np.concatenate([t[k] for t in tokens]) for k in (0, 1))
        n_a, n_b = (np.array([len(t[k]) for t in tokens]) for k in (0, 1))
        own_a, own_b = np.repeat(np.arange(rows), n_a), np.repeat(np.arange(rows), n_b)
        ends_a, ends_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        group_a, group_b = coalesce(ends_a, ends_b)
        of_a, of_b = overlaps(ends_a, ends_b)
        span = len(self.a_bytes) * self.width
        pairs, times = np.unique(own_a[of_a] * span + a[of_a] * self.width + b[of_b], return_counts=True)
        texts = _groups_text(self.names, np.concatenate((a, b)), np.repeat([0, 1], [len(a), len(b)]),
                             np.concatenate((group_a, group_b)), np.concatenate((own_a, own_b)), rows)
        opens = np.concatenate(([True], group_a[1:] != group_a[:-1]))
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(own_a[opens], minlength=rows),
                "n_links": np.bincount(own_a[of_a], minlength=rows), "texts": texts,
                "pairs": pairs % span, "times": times, "edge": np.searchsorted(pairs, np.arange(rows + 1) * span)}

    def long_text(self, text: str):
        """The same for one text, piece by piece; None if it has no tokens."""
        counts, sha, pairs, times = np.zeros(4, np.int64), hashlib.sha256(), np.empty(0, np.int64), np.empty(0, np.int64)
        for k, piece in enumerate(self.pieces(text)):
            tokens = self.encode(piece, k == 0)
            if tokens is None:
                return None
            got = self.align([tokens])
            counts += [got[c][0] for c in ("n_a", "n_b", "n_groups", "n_links")]
            sha.update(b";" * (k > 0) + got["texts"][0])
            pairs, place = np.unique(np.concatenate((pairs, got["pairs"])), return_inverse=True)
            times = np.bincount(place, np.concatenate((times, got["times"])), len(pairs)).astype(np.int64)
        return counts, sha.hexdigest(), pairs, times


_ALIGNERS: dict[int, Aligner] = {}


def token_links(df: DataFrame, a_file: str, pattern: str, b_model: bytes, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: a row number, the counts, the digest of its groups,
    and its distinct linked pairs (A id x B vocabulary + B id) with their times."""
    spark = df.sparkSession
    bound_batches(spark)
    file = spark.sparkContext.broadcast((a_file, pattern, b_model))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        key = hash(file.value)
        if key not in _ALIGNERS:
            _ALIGNERS[key] = Aligner(*file.value)
        al, row = _ALIGNERS[key], TaskContext.get().partitionId() << 33
        names = [f.split()[0] for f in DOCS.split(", ")]

        def record(ids, n_a, n_b, n_groups, n_links, sha, edge, pairs, times):
            nonlocal row
            rows = np.arange(row, row + len(ids))
            row += len(ids)
            lists = [pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(v, t))
                     for v, t in ((pairs, pa.int64()), (times, pa.int32()))]
            return pa.record_batch([pa.array(rows), pa.array(ids, pa.int64()),
                                    *[pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)],
                                    pa.array(sha, pa.string()), *lists], names)

        def group(ids, tokens):
            got = al.align(tokens)
            return record(ids, got["n_a"], got["n_b"], got["n_groups"], got["n_links"],
                          [hashlib.sha256(t).hexdigest() for t in got["texts"]],
                          got["edge"], got["pairs"], got["times"])

        ids, tokens, none, chars = [], [], [], 0
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                if text and len(text) > GROUP_CHARS:
                    got = al.long_text(text)
                    if got is None:
                        none.append(doc)
                    else:
                        counts, sha, pairs, times = got
                        yield record([doc], *[[c] for c in counts.tolist()], [sha], [0, len(pairs)], pairs, times)
                    continue
                pair = al.encode(text, True) if text else None
                if pair is None:
                    none.append(doc)
                    continue
                ids.append(doc)
                tokens.append(pair)
                chars += len(text)
                if chars >= GROUP_CHARS:
                    yield group(ids, tokens)
                    ids, tokens, chars = [], [], 0
        if ids:
            yield group(ids, tokens)
        if none:
            zero = [0] * len(none)
            yield record(none, zero, zero, zero, zero, [""] * len(none), [0] * (len(none) + 1), [], [])

    return (df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
            .mapInArrow(run, DOCS))


def pair_counts(links: DataFrame, width: int) -> DataFrame:
    """``pair, count, best`` over all ``links(pair, n)``; ``best``: no pair of the
    same B id (the pair modulo ``width``) counts more."""
    counts = materialize(links.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    most = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("count").alias("most"))
    return (counts.withColumn("b", F.col("pair") % width).join(most, "b")
            .select("pair", "count", (F.col("count") == F.col("most")).alias("best")))


def _level():
    """Counts by size: eight steps a doubling."""
    return F.floor(F.log2("count") * 8).cast("int")


def align(df: DataFrame, a_file: str, pattern: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text",
          hot: int = HOT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    per document; ``hot`` bounds the broadcast pairs, not the result."""
    import sentencepiece
    width = sentencepiece.SentencePieceProcessor(model_proto=b_model).vocab_size()
    docs = materialize(token_links(df, a_file, pattern, b_model, id_col, text_col), "links")
    links = docs.select("row", F.inline(F.arrays_zip("pairs", "times"))).toDF("row", "pair", "n")
    table = materialize(pair_counts(links.select("pair", "n"), width), "pairs")
    # a few hundred levels at most
    levels = table.groupBy(_level().alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    cut, room = 1 << 30, hot
    for r in levels:
        if r["n"] > room:
            break
        cut, room = r["level"], room - r["n"]
    common = F.broadcast(table.filter(_level() >= cut))
    parts = [links.join(common, "pair").select("row", "n", "count", "best")]
    if levels and cut > levels[-1]["level"]:
        rare = table.filter(_level() < cut)
        parts.append(links.join(F.broadcast(table.filter(_level() >= cut).select("pair")), "pair", "left_anti")
                     .join(rare, "pair").select("row", "n", "count", "best"))
    sums = [p.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
                                 F.sum(F.col("n") * F.col("count")).alias("count_sum")) for p in parts]
    total = sums[0] if len(sums) == 1 else (sums[0].unionByName(sums[1]).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    own = docs.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (own.join(total, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"))

"""Byte-level BPE encoding and decoding with the tokenizers library.

Bytes map to printable characters and back by the usual byte table; a rank
file becomes a vocabulary over those characters plus every merge that forms a
ranked token from two others, in rank order. A text is cut at single spaces
between non-space characters (the pre-tokenizer always cuts there too), so the
ids of a unit do not depend on its neighbours: each worker encodes a unit once
through ``encode_batch`` and keeps it in a bounded table. Decoding looks up
the bytes of each id and joins them before any character is formed, so
characters split over several tokens come back whole.

Cases: null text counts as empty (no ids); texts of any length are encoded
whole; strings of special tokens are ordinary text; rows, ids and other
columns are only passed through, so repeats, nulls and clashing names do not
matter. The tokenizer file (about 1.5 MB) is the only thing broadcast.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.llm.membership import bound_batches

#: Units of at most so many characters are remembered, so many of them.
UNIT_CHARS, UNITS_KEPT = 48, 400_000
#: Texts encoded at a time: rows, and characters after which a group ends.
GROUP_ROWS, GROUP_CHARS = 256, 1 << 20

_CUT = re.compile(r"(?<=\S)(?= \S)")


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones themselves,
    the others shifted past 255 in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def tokenizer_json(ranks: dict[bytes, int], pattern: str) -> str:
    """A tokenizers file that encodes by ``ranks`` within each match of
    ``pattern``, without special tokens."""
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers
    chars = byte_characters()
    name = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = [(name[t[:i]], name[t[i:]]) for t in sorted(ranks, key=ranks.get)
              for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    tok = Tokenizer(models.BPE({name[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    tok.decoder = decoders.ByteLevel()
    return tok.to_str()


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, text: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(text)
        self.tok.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        back = {c: b for b, c in enumerate(byte_characters())}
        vocab = json.loads(text)["model"]["vocab"]
        self.pieces = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            if all(c in back for c in piece):
                self.pieces[i] = bytes(back[c] for c in piece)
        self.lengths = np.array([len(p) for p in self.pieces])

    def _raw(self, units: list[str]) -> list[bytes]:
        """Ids of each unit. Units that begin with a space follow each other
        in one text, since it is cut between them anyway; where one ends is
        read off the byte lengths of the ids."""
        if not units:
            return []
        joined = [u for u in units if u[0] == " "]
        got = dict(self._joined(joined))
        rest = [u for u in units if u[0] != " "]
        got.update(zip(rest, (np.array(e.ids, "<u4").tobytes() for e in
                              self.tok.encode_batch_fast(rest, add_special_tokens=False))))
        return [got[u] for u in units]

    def _joined(self, units: list[str]):
        at = 0
        while at < len(units):
            part = units[at:at + 2000]
            ids = np.array(self.tok.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, "<u4")
            size = np.cumsum([len(u.encode()) for u in part])
            cut = 4 * np.searchsorted(np.cumsum(self.lengths[ids]), size, "left") + 4
            raw, start = ids.tobytes(), 0
            for u, end in zip(part, cut.tolist()):
                yield u, raw[start:end]
                start = end
            at += len(part)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and end - at < GROUP_ROWS and (end == at or size < GROUP_CHARS):
                size += len(texts[end] or "")
                end += 1
            out += self._group(texts[at:end])
            at = end
        return out

    def _group(self, texts: list[str | None]) -> list[bytes]:
        known = self.known
        cut = [_CUT.split(t) if t else [] for t in texts]
        new = [u for u in {u for units in cut for u in units} if u not in known]
        if len(known) + len(new) > UNITS_KEPT:
            known.clear()
            new = list({u for units in cut for u in units})
        table = dict(zip(new, self._raw(new))) if new else {}
        known.update((u, ids) for u, ids in table.items() if len(u) <= UNIT_CHARS)
        long = {u: ids for u, ids in table.items() if len(u) > UNIT_CHARS}
        if not long:
            return [b"".join(map(known.__getitem__, units)) for units in cut]
        return [b"".join(known[u] if u in known else long[u] for u in units) for units in cut]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ``ids`` stand for."""
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def offsets(self, text: str, ids: bytes) -> list[tuple[int, int]]:
        """Character span of each id: first character it holds a byte of, and
        one past the last."""
        data = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80) - 1
        end = np.cumsum(self.lengths[np.frombuffer(ids, "<u4")])
        start = np.concatenate(([0], end[:-1])) if len(end) else end
        return [(int(char[a]), int(char[b - 1]) + 1) for a, b in zip(start, end)]


_CODECS: dict[int, Codec] = {}


def codec(text: str) -> Codec:
    """This process's codec for a tokenizer file (made once)."""
    key = hash(text)
    if key not in _CODECS:
        _CODECS[key] = Codec(text)
    return _CODECS[key]


def shipped(spark, text: str):
    """A tokenizer file as a broadcast value."""
    return spark.sparkContext.broadcast(text)


def rank_file_json(path: str, pattern: str) -> str:
    return tokenizer_json(read_ranks(path), pattern)


def encode_decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  digests: bool = True, with_ids: bool = False, with_offsets: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens``; with ``digests`` the
    SHA-256 of the ids and of the decoded bytes; with ``with_ids`` /
    ``with_offsets`` the ids and their character spans."""
    import hashlib
    schema = "doc_id long, n_tokens long"
    schema += ", ids_sha256 string, decoded_sha256 string" if digests else ""
    schema += ", ids array<int>" if with_ids else ""
    schema += ", offsets array<struct<start:int,end:int>>" if with_offsets else ""
    bound_batches(df.sparkSession)
    file = shipped(df.sparkSession, tokenizer)

    def run(batches):
        import pyarrow as pa
        c = codec(file.value)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP_ROWS):
                part = batch.slice(at, GROUP_ROWS)
                texts = part.column(1).to_pylist()
                ids = c.encode(texts)
                cols = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64())]
                if digests:
                    cols += [pa.array([sha(x) for x in ids]), pa.array([sha(c.decode(x)) for x in ids])]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids],
                                         pa.list_(pa.int32())))
                if with_offsets:
                    cols.append(pa.array([[{"start": a, "end": b} for a, b in c.offsets(t or "", x)]
                                          for t, x in zip(texts, ids)],
                                         pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
                yield pa.record_batch(cols, [f.split()[0] for f in
                                             ["doc_id", "n_tokens", *["ids_sha256", "decoded_sha256"] * digests,
                                              *["ids"] * with_ids, *["offsets"] * with_offsets]])

    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)

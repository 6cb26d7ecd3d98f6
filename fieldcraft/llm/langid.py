"""Language identification with string kernels.

Texts are cut into passages of ``PASSAGE`` bytes (every byte of every text
lies in one). A passage is the set of its byte n-grams of 2, 3 and 4 bytes
(letters only, ASCII lower-cased, everything else one separator), hashed into
``DIM`` presence bits. The kernel of two passages is the size of their common
set over the geometric mean of their sizes. With ``LANDMARKS`` landmark passages
the Nystroem map turns a passage into K(x, L) K(L, L)^-1/2, and one-versus-rest
kernel ridge regression on it is a linear map, so scoring a block of passages
is two matrix products. A text's score per language is the mean over its
passages, weighted by their letters; the prediction is the largest, ties go to
the first language by name, and ``score`` is its softmax share.

The model is fitted on a bounded sample: about ``PER_LANG`` labelled texts of
each language (those with the smallest hash, never more than twice as many),
at most ``PER_TEXT`` evenly spaced passages of each. Labels, sources and ids
are not used in a prediction. The fitted model (a few MB) is broadcast.

Cases: null texts and texts without a letter are ``und`` with score 0; null
labels are not learned from; a text of any length is read whole; repeated rows
are scored separately; with no labelled row at all every text is ``und``; other
columns are ignored, and pass through ``keep_known`` untouched.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.llm.membership import bound_batches
from fieldcraft.llm.shingles import blocks

DIM, PASSAGE, LANDMARKS, RIDGE, SHARPNESS = 1 << 13, 2048, 128, 1e-2, 6.0
PER_LANG, PER_TEXT = 500, 4
ROWS = 256

_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def passages(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each passage, its document) for documents at ``starts``."""
    sizes = np.diff(np.append(starts, len(data)))
    per = -(-sizes // PASSAGE)
    doc = np.repeat(np.arange(len(starts)), per)
    first = np.cumsum(per) - per
    return starts[doc] + (np.arange(len(doc)) - first[doc]) * PASSAGE, doc


def presence(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """0/1 rows of the passages [begin, end) and their numbers of letter
    bytes. n-grams do not leave a passage; runs of separators count as one."""
    out = np.zeros((len(begin), DIM), np.float32)
    flat, letters = out.ravel(), np.zeros(len(begin))
    if not len(begin):
        return out, letters
    size = end - begin
    row = np.repeat(np.arange(len(begin), dtype=np.int64), size)
    at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    text = _FOLD[data[at]]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != 32) | (text[:-1] != 32) | (row[1:] != row[:-1])
    text, row = text[keep], row[keep]
    letters += np.bincount(row, weights=text != 32, minlength=len(begin))
    wide = text.astype(np.uint32) + np.uint32(1)
    code = wide * _MULT[0]
    for n in (2, 3, 4):
        if len(wide) < n:
            break
        code = code[:len(wide) - n + 1] + wide[n - 1:] * _MULT[n - 1]
        mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        inside = row[:len(mixed)] == row[n - 1:]
        flat[(row[:len(mixed)] * DIM + (mixed >> np.uint32(32 - 13)).astype(np.int64))[inside]] = 1
    return out, letters


class Model:
    """Landmarks, their sizes and the ridge weights, as plain arrays."""

    def __init__(self, langs: list[str], landmarks: np.ndarray, weights: np.ndarray) -> None:
        self.langs, self.landmarks, self.weights = langs, landmarks, weights
        self.sizes = np.maximum(landmarks.sum(1), 1)

    def kernel(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.landmarks.T) / np.sqrt(np.maximum(x.sum(1), 1)[:, None] * self.sizes[None, :])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.weights


def fit(x: np.ndarray, y: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """One-versus-rest kernel ridge regression on Nystroem features; the
    landmarks are dealt evenly over the languages, in the order given."""
    langs = sorted(set(y))
    lab = np.array([langs.index(v) for v in y])
    take = [np.flatnonzero(lab == k) for k in range(len(langs))]
    share = max(1, landmarks // max(1, len(langs)))
    chosen = np.concatenate([t[:share] for t in take]) if langs else np.empty(0, int)
    m = Model(langs, x[chosen], np.zeros((len(chosen), len(langs)), np.float32))
    if not langs:
        return m
    value, vec = np.linalg.eigh(m.kernel(x[chosen]).astype(np.float64))
    root = vec * (np.maximum(value, 0) > 1e-6) / np.sqrt(np.maximum(value, 1e-6)) @ vec.T
    phi = m.kernel(x).astype(np.float64) @ root
    # each language weighs the same, however many passages it has
    w = (len(lab) / len(langs) / np.bincount(lab, minlength=len(langs)))[lab]
    target = (lab[:, None] == np.arange(len(langs))).astype(np.float64)
    a = phi.T @ (phi * w[:, None]) + ridge * len(lab) / len(chosen) * np.eye(len(chosen))
    m.weights = (root @ np.linalg.solve(a, phi.T @ (target * w[:, None]))).astype(np.float32)
    return m


def sample(docs: DataFrame, train, lang_col: str, id_col: str, text_col: str,
           per_lang: int = PER_LANG) -> tuple[np.ndarray, list[str]]:
    """Passages and labels of the bounded training sample."""
    rows = (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{lang_col}`").alias("lang"),
                        F.col(f"`{text_col}`").alias("text"))
            .filter(train(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    known = rows.groupBy("lang").count()
    # one row per language: the share of its texts that gives about per_lang
    rate = known.select(F.col("lang").alias("l"), F.least(F.lit(1.0), per_lang / F.col("count")).alias("rate"))
    draw = F.pmod(F.xxhash64(F.lit(17), F.col("id")), F.lit(1 << 30)) / float(1 << 30)
    picked = (rows.join(F.broadcast(rate), F.col("lang") == F.col("l")).filter(draw < F.col("rate")))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            langs, ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for row, data, starts in blocks(batch.column(2)):
                begin, doc = passages(data, starts)
                first = np.searchsorted(doc, np.arange(len(starts)))
                count = np.bincount(doc, minlength=len(starts))
                pick = np.unique(np.concatenate([first[count > 0] + (count[count > 0] * k) // PER_TEXT
                                                 for k in range(PER_TEXT)])) if len(doc) else np.empty(0, int)
                stop = np.minimum(begin + PASSAGE, np.append(starts, len(data))[doc + 1])
                for a in range(0, len(pick), ROWS):
                    p = pick[a:a + ROWS]
                    x, letters = presence(data, begin[p], stop[p])
                    bits = np.packbits(x.astype(np.uint8), axis=1)
                    out = [(ids[row + doc[i]], langs[row + doc[i]], b.tobytes())
                           for i, b, n in zip(p, bits, letters) if n]
                    if out:
                        yield pa.record_batch([pa.array([o[k] for o in out]) for k in range(3)], ["id", "lang", "bits"])

    got = picked.select("id", "lang", "text").mapInArrow(run, "id long, lang string, bits binary")
    # bounded: per_lang texts a language, PER_TEXT passages a text, 1 KB each
    table = got.orderBy(F.xxhash64("id", "bits"), "lang").limit(2 * per_lang * PER_TEXT * max(1, known.count())).toArrow()
    if not table.num_rows:
        return np.empty((0, DIM), np.float32), []
    bits = np.stack([np.frombuffer(b.as_py(), np.uint8) for b in table.column("bits")])
    return np.unpackbits(bits, axis=1).astype(np.float32), table.column("lang").to_pylist()


def train_rows(ident):
    """Rows that may be learned from: crc32 of the id as text, mod 4, not 2."""
    return F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(4)) != 2


def _predict(model: Model, column) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of an Arrow column."""
    n = len(column)
    total, weight = np.zeros((n, max(1, len(model.langs)))), np.zeros(n)
    for row, data, starts in blocks(column):
        begin, doc = passages(data, starts)
        stop = np.minimum(begin + PASSAGE, np.append(starts, len(data))[doc + 1])
        for a in range(0, len(doc), ROWS):
            b = slice(a, a + ROWS)
            x, letters = presence(data, begin[b], stop[b])
            if model.langs:
                np.add.at(total, row + doc[b], model.scores(x) * letters[:, None])
            np.add.at(weight, row + doc[b], letters)
    total /= np.maximum(weight, 1)[:, None]
    e = np.exp(SHARPNESS * (total - total.max(1, keepdims=True)))
    share = e.max(1) / e.sum(1)
    best = total.argmax(1)
    ok = [bool(model.langs) and t is not None and _LETTER.search(t) is not None for t in column.to_pylist()]
    return ([model.langs[k] if o else "und" for k, o in zip(best, ok)], np.where(ok, share, 0.0))


def trained(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> Model:
    bound_batches(docs.sparkSession)
    return fit(*sample(docs, train_rows, lang_col, id_col, text_col))


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per document."""
    model = docs.sparkSession.sparkContext.broadcast(trained(docs, id_col, text_col, lang_col))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            lang, share = _predict(model.value, batch.column(2))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(lang, pa.string()),
                                   pa.array(share, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    ident = F.col(f"`{id_col}`").cast("long")
    return (docs.select(ident.alias("doc_id"), F.coalesce(~train_rows(ident), F.lit(False)).alias("held_out"),
                        F.col(f"`{text_col}`").alias("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose text has a known language with a score of at
    least ``least``, with their own columns."""
    model = docs.sparkSession.sparkContext.broadcast(trained(docs, id_col, text_col, lang_col))
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            lang, share = _predict(model.value, batch.column(at))
            keep = [v != "und" and s >= least for v, s in zip(lang, share)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

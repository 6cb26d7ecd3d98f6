"""Best-fit packing of documents into fixed token windows, in supersteps.

Pieces (whole documents, or window-long cuts of longer ones) and gaps (free
room of open windows) are rows of two tables. One superstep:

1. range-sort pieces and gaps together by size, largest first, gaps before
   pieces of the same size;
2. sweep every range partition: a piece takes the nearest gap before it that
   is still free, i.e. its successor in size (a run of equal pieces takes the
   last gaps in one step); one gap serves one piece, rank decides conflicts;
3. pieces and gaps left over in different partitions are matched by rank too:
   the driver sees two counts per partition, never a row;
4. update the gaps (a grouped sum); pieces larger than every gap can only open
   new windows, which the top size class does, filled by next fit in size order;
5. repeat until no piece is left.

A gap that could hold several of the largest remaining pieces may be offered as
several slots, so collections of tiny documents do not need a superstep per
document; the further slots come from the largest gaps and are no more than the
pieces left, plus one a gap. The number of supersteps follows the window and the spread of sizes,
not the number of documents; every step moves narrow rows (ids and sizes) only.

Cases: null text is an empty document (the end id alone); a text of any length
is encoded whole; strings of added tokens in a text get their ids, as in the library; repeated ids and rows are separate documents (rows are
numbered internally); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldcraft.llm.bpe import byte_characters
from fieldcraft.llm.membership import bound_batches
from fieldcraft.session import materialize

WINDOW, END_ID = 2048, 0
TASK_ROWS = 50_000
PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


# --- token pieces ---------------------------------------------------------

class Ranks:
    """The byte ranks of a tokenizers file; the same merges as the file's own
    library makes, several times faster. ``encode`` reads special tokens' strings
    as ordinary text. ``pieces``: the bytes of each id."""

    def __init__(self, text: str, pattern: str) -> None:
        import tiktoken
        back = {c: b for b, c in enumerate(byte_characters())}
        vocab = json.loads(text)["model"]["vocab"]
        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if all(c in back for c in t)}
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.pieces[i] = raw
        self.enc = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.added = [t["content"] for t in json.loads(text).get("added_tokens", [])]
        self.file, self.library = text, None

    def encode(self, text: str) -> np.ndarray:
        return self.enc.encode_to_numpy(text, disallowed_special=())

    def encode_added(self, text: str) -> np.ndarray:
        """As the library does by default: strings of the file's added tokens get
        those tokens' ids. Texts that hold one are left to the library itself."""
        if not any(t in text for t in self.added):
            return self.encode(text)
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_str(self.file)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)


_RANKS: dict[int, Ranks] = {}


def cut(n_tokens: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: the first takes what is
    over after whole windows."""
    first = n_tokens % window or min(n_tokens, window)
    out, at = [(0, first)], first
    while at < n_tokens:
        out.append((at, window))
        at += window
    return out


def token_pieces(df: DataFrame, tokenizer: str, pattern: str, id_col: str, text_col: str,
                 window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    bound_batches(df.sparkSession)
    file = df.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        key = hash((file.value, pattern))
        if key not in _RANKS:
            _RANKS[key] = Ranks(file.value, pattern)
        enc, row = _RANKS[key], TaskContext.get().partitionId() << 33
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(enc.encode_added(text.as_py() or ""), end_id).astype("<u4")
                raw = memoryview(ids.tobytes())
                for k, (start, length) in enumerate(cut(len(ids), window)):
                    out.append((row, doc, k, start, length, zlib.crc32(raw[4 * start:4 * (start + length)])))
                    row += 1
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(
                cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    return (df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
            .mapInArrow(run, PIECES))


# --- supersteps -------------------------------------------------------------

SWEPT = "kind int, id long, size long, mate long, part int, rank long"


def _columns(batches, names):
    got = [[np.asarray(b.column(n)) for n in names] for b in batches if b.num_rows]
    return [np.concatenate(c) for c in zip(*got)] if got else [np.empty(0, np.int64) for _ in names]


def match_sorted(kind: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For rows sorted by size descending, gaps (kind 0) before pieces (kind
    1) of a size: the row of the gap that each piece takes, -1 for none."""
    mate = np.full(len(kind), -1, np.int64)
    edges = np.flatnonzero((np.diff(size) != 0) | (np.diff(kind) != 0)) + 1
    free: list[list[int]] = []
    for a, b in zip([0, *edges], [*edges, len(kind)]):
        if a == b:
            continue
        if kind[a] == 0:
            free.append([a, b])
            continue
        while a < b and free:
            lo, hi = free[-1]
            k = min(b - a, hi - lo)
            mate[a:a + k] = np.arange(hi - 1, hi - 1 - k, -1)
            a += k
            free[-1][1] -= k
            if free[-1][1] == lo:
                free.pop()
    return mate


def _sweep(batches):
    import pyarrow as pa
    from pyspark import TaskContext
    kind, size, ident = _columns(batches, ["kind", "size", "id"])
    if not len(kind):
        return
    mate_row = match_sorted(kind, size)
    took = np.flatnonzero(mate_row >= 0)
    mate = np.full(len(kind), -1, np.int64)
    mate[took] = ident[mate_row[took]]
    mate[mate_row[took]] = ident[took]
    rank = np.zeros(len(kind), np.int64)
    for k in (0, 1):
        left = np.flatnonzero((kind == k) & (mate < 0))
        rank[left] = np.arange(len(left))
    yield pa.record_batch([
        pa.array(kind, pa.int32()), pa.array(ident), pa.array(size),
        pa.array(mate, mask=mate < 0), pa.array(np.full(len(kind), TaskContext.get().partitionId(), np.int32)),
        pa.array(rank)], ["kind", "id", "size", "mate", "part", "rank"])


def carry_plan(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """From (partition, gaps left, pieces left), largest sizes first: intervals
    (piece partition, first piece rank, gap partition, gap rank, how many);
    pieces take gaps of the nearest partition before theirs, last rank first."""
    free: list[list[int]] = []
    out = []
    for part, gaps, pieces in sorted(counts):
        at = 0
        while at < pieces and free:
            q, left = free[-1]
            k = min(pieces - at, left)
            out.append((part, at, q, left - 1, k))
            at += k
            free[-1][1] -= k
            if not free[-1][1]:
                free.pop()
        if gaps:
            free.append([part, gaps])
    return out


def _fill(window: int):
    """Next fit in size order: pieces of one task into new windows, each named
    after its first piece."""
    def run(batches):
        import pyarrow as pa
        size, ident = _columns(batches, ["length", "row"])
        if not len(size):
            return
        total, bins, at = np.cumsum(size), np.empty(len(size), np.int64), 0
        while at < len(size):
            end = int(np.searchsorted(total, (total[at - 1] if at else 0) + window, "right"))
            bins[at:end] = ident[at]
            at = end
        yield pa.record_batch([pa.array(ident), pa.array(size), pa.array(bins)], ["row", "length", "bin"])
    return run


def class_edges(window: int) -> list[int]:
    """Lower edges of the size classes: a half, a third, a quarter of the
    window, then one class per halving."""
    edges, at = [window // 2, window // 3], window // 4
    while at:
        edges.append(at)
        at //= 2
    return [*edges, 0]


def _class_of(length: int, window: int) -> int:
    return next(k for k, e in enumerate(class_edges(window)) if length > e)


def _class(length, window: int):
    """Number of the size class of a length column."""
    out = F.lit(len(class_edges(window)) - 1)
    for k, e in reversed(list(enumerate(class_edges(window)))):
        out = F.when(length > e, k).otherwise(out)
    return out


def gap_sizes(gaps: DataFrame) -> dict[int, int]:
    """How many gaps there are of each size (at most ``window`` sizes)."""
    return {r["gap"]: r["count"] for r in gaps.groupBy("gap").count().collect()}


def spare_slots(sizes: dict[int, int], pieces: int, largest: int) -> tuple[int, int, int]:
    """From how many gaps there are of each size: ``(edge, at_edge, total)``. Gaps
    above ``edge`` are offered as all the slots of ``largest`` that they hold, gaps of
    size ``edge`` as ``at_edge`` slots, smaller ones as one; ``total`` slots. The largest
    gaps come first, until the further slots would serve all ``pieces``."""
    want, total, count = pieces, sum(sizes.values()), 0
    for size in sorted(sizes, reverse=True):
        more = size // largest - 1
        if more <= 0:
            break
        each = min(more, -(-want // sizes[size]))
        total += each * sizes[size]
        want -= each * sizes[size]
        if want <= 0:
            return size, each + 1, total
        count = size
    return max(count - 1, 0), 1, total


def pack(pieces: DataFrame, window: int = WINDOW, task_rows: int = TASK_ROWS) -> DataFrame:
    """``pieces(row, length)`` with unique rows and 1 <= length <= window ->
    ``(row, bin)``; a bin is named after one of its rows. ``task_rows``: rows
    of a sorted partition, which decides how many there are."""
    spark = pieces.sparkSession
    placed = [pieces.filter(F.col("length") * 2 > window).select("row", "length", F.col("row").alias("bin"))]
    gaps = placed[0].select("bin", (window - F.col("length")).alias("gap")).filter("gap > 0")
    left = pieces.filter(F.col("length") * 2 <= window).select("row", "length")
    sizes = gap_sizes(gaps)
    while True:
        size = left.agg(F.count("*").alias("n"), F.min("length").alias("lo"), F.max("length").alias("hi")).first()
        if not size["n"]:
            break
        edge, at_edge, n_slots = spare_slots({g: c for g, c in sizes.items() if g >= size["lo"]}, size["n"], size["hi"])
        slots = (gaps.filter(F.col("gap") >= size["lo"])
                 .withColumn("m", F.when(F.col("gap") > edge, F.greatest(F.lit(1), F.floor(F.col("gap") / size["hi"])))
                             .when(F.col("gap") == edge, F.lit(at_edge)).otherwise(F.lit(1)).cast("int"))
                 .select("bin", F.explode(F.sequence(F.lit(1), F.col("m"))).alias("k"), "m", "gap")
                 .select(F.lit(0).alias("kind"), F.col("bin").alias("id"),
                         F.when(F.col("k") < F.col("m"), F.lit(size["hi"]))
                         .otherwise(F.col("gap") - (F.col("m") - 1) * size["hi"]).cast("long").alias("size")))
        n = -(-(size["n"] + n_slots) // task_rows)
        rows = slots.unionByName(left.select(F.lit(1).alias("kind"), F.col("row").alias("id"),
                                             F.col("length").cast("long").alias("size")))
        order = [F.col("size").desc(), F.col("kind"), F.col("id")]
        swept = materialize(rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
                            .mapInArrow(_sweep, SWEPT), "sweep")
        over = swept.filter("mate IS NULL")
        counts = (over.groupBy("part").agg(F.count(F.when(F.col("kind") == 0, 1)).alias("g"),
                                           F.count(F.when(F.col("kind") == 1, 1)).alias("p")).collect())
        plan = carry_plan([(r["part"], r["g"], r["p"]) for r in counts])
        now = [swept.filter("kind = 1 AND mate IS NOT NULL")
               .select(F.col("id").alias("row"), F.col("size").alias("length"), F.col("mate").alias("bin"))]
        rest = over.filter("kind = 1")
        if plan:
            # at most two rows per partition
            table = F.broadcast(spark.createDataFrame(plan, "part int, first long, q int, top long, k long"))
            want = (rest.join(table, "part")
                    .filter("rank >= first AND rank < first + k")
                    .select(F.col("id").alias("row"), F.col("size").alias("length"), "q",
                            (F.col("top") - F.col("rank") + F.col("first")).alias("j")))
            free = over.filter("kind = 0").select(F.col("part").alias("q"), F.col("rank").alias("j"),
                                                  F.col("id").alias("bin"))
            now.append(materialize(want.join(free, ["q", "j"]).select("row", "length", "bin"), "carried"))
            taken = table.groupBy("part").agg(F.max(F.col("first") + F.col("k")).alias("upto"))
            rest = rest.join(F.broadcast(taken), "part", "left").filter("upto IS NULL OR rank >= upto")
        for t in now:
            placed.append(t)
        used = now[0] if len(now) == 1 else now[0].unionByName(now[1])
        gaps = (gaps.unionByName(used.select("bin", (-F.col("length")).alias("gap")))
                .groupBy("bin").agg(F.sum("gap").alias("gap")).filter("gap > 0"))
        gaps = materialize(gaps, "gaps")
        left = materialize(rest.select(F.col("id").alias("row"), F.col("size").alias("length")), "left")
        sizes = gap_sizes(gaps)
        largest = max(sizes, default=0)
        hopeless = left.filter(F.col("length") > largest)
        top = hopeless.agg(F.max("length").alias("length"), F.count("*").alias("n")).first()
        if top["n"]:
            top_class = _class_of(top["length"], window)
            new = hopeless.filter(_class(F.col("length"), window) == top_class)
            order = [F.col("length").desc(), F.col("row")]
            opened = materialize(new.repartitionByRange(-(-top["n"] // task_rows), *order).sortWithinPartitions(*order)
                                 .mapInArrow(_fill(window), "row long, length long, bin long"), "opened")
            placed.append(opened)
            new_gaps = opened.groupBy("bin").agg((window - F.sum("length")).alias("gap")).filter("gap > 0")
            for g, c in gap_sizes(new_gaps).items():
                sizes[g] = sizes.get(g, 0) + c
            gaps = gaps.unionByName(new_gaps)
            left = left.filter((F.col("length") <= largest) | (_class(F.col("length"), window) != top_class))
    out = placed[0]
    for t in placed[1:]:
        out = out.unionByName(t)
    return out.select("row", "bin")


def pack_documents(df: DataFrame, tokenizer: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``; places in a window are gapless, larger pieces
    first (at most ``window`` rows share a window)."""
    pieces = materialize(token_pieces(df, tokenizer, pattern, id_col, text_col, window, end_id), "pieces")
    bins = pack(pieces.select("row", "length"), window)
    w = Window.partitionBy("bin").orderBy(F.col("length").desc(), F.col("row"))
    return (pieces.join(bins, "row")
            .withColumn("offset", F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    F.col("bin").alias("sequence_id"), "offset"))

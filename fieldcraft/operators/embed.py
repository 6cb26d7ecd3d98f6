"""Embedding-table interaction operators (N01-N07) for batch feature
generation over a weights table ``emb(vec_id, vec ARRAY<DOUBLE>)``.

Rows are reduced to their keys and the ids of the weights that they need, hash
partitioned on the key and packed into blocks of a few thousand rows. One join of
the blocks' distinct ids with the weights table finds the vectors: a vector moves
once per block that needs it, not once per row or token. Block and vectors meet in
one cogrouped task, which looks up, pools, multiplies or scores with array
operations, some rows at a time; no row's vectors are shuffled, sorted or
aggregated by Spark.

Cases: rows with equal keys count as one row (their tokens add up); an id without
vector, or a null vector, is missing; an id that the weights hold several times
counts that often in a pool and once in a field; null elements make what is
computed from them null, pools leave them out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcraft.functions.text import cell_tokens
from fieldcraft.session import materialize


def weights(emb: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    return emb.select(F.col(id_col).alias("vec_id"),
                      F.transform(vec_col, lambda x: x.cast("double")).alias("vec"))


def vec_id(value: Column, field_no: int, n: int, mult: int = 31) -> Column:
    """Deterministic row of the weights table for a (field, value):
    ``(value * mult + field_no) mod n``, computed on ``value mod n`` so that no
    64-bit value overflows the product. Null for a null value."""
    return F.pmod(F.pmod(value.cast("long"), F.lit(n)) * F.lit(mult) + F.lit(field_no), F.lit(n))


#: how a (field, value) finds its row of the weights table
Index = Callable[[Column, int], Column]


def hashed(n: int, mult: int = 31) -> Index:
    """Rows by :func:`vec_id`; fields share the table."""
    return lambda value, field_no: vec_id(value, field_no, n, mult)


# ------------------------------------------------------------------ blocks of rows and their vectors
#: rows whose vectors are held at a time
CHUNK = 1024
#: elements of a computed matrix held at a time
_ELEMENTS = 1 << 18


def _dim(emb: DataFrame) -> int:
    got = emb.filter("vec IS NOT NULL").select(F.size("vec").alias("n")).first()
    return got["n"] if got else 0


def _array_type(t: T.DataType) -> T.ArrayType:
    return T.ArrayType(t, True)


def _starts(table, keep: Sequence[str]) -> np.ndarray:
    """Where the runs of equal keys begin."""
    import pyarrow.compute as pc
    new = np.zeros(max(table.num_rows - 1, 0), bool)
    for c in keep:
        code = pc.dictionary_encode(table.column(c).combine_chunks(), null_encoding="encode").indices.to_numpy()
        new |= np.diff(code) != 0
    return np.concatenate(([0], np.flatnonzero(new) + 1)) if table.num_rows else np.empty(0, np.int64)


def _pack(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``rows(keep..., _ids array<long>)`` as blocks, written: ``block``, the keys, the
    pointers ``ptr`` of each key's ids in ``ids`` (-1: none), and the distinct ones.
    Rows of one key follow each other in a partition and become one."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField("block", T.LongType()), *[T.StructField(c, _array_type(kinds[c])) for c in keep],
                           *[T.StructField(c, _array_type(T.LongType())) for c in ("ptr", "ids", "need")]])

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        at, rest = TaskContext.get().partitionId() << 33, None

        def block(table, starts):
            nonlocal at
            ids = table.column("_ids").combine_chunks()
            size = np.asarray(pc.list_value_length(ids).fill_null(0), np.int64)
            ends = np.append(np.concatenate(([0], np.cumsum(size)))[starts], size.sum())
            flat = np.asarray(pc.list_flatten(ids).fill_null(-1), np.int64)
            first = table.take(pa.array(starts))
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            known = np.unique(flat)
            cols = [pa.array([at], pa.int64()), *[one(first.column(c).combine_chunks()) for c in keep],
                    *[one(pa.array(x, pa.int64())) for x in (ends, flat, known[known >= 0])]]
            at += 1
            return pa.record_batch(cols, schema.names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            starts = _starts(table, keep)
            if len(starts):
                # the last key may go on in the next batch
                rest = table.slice(int(starts[-1]))
                if len(starts) > 1:
                    yield block(table.slice(0, int(starts[-1])), starts[:-1])
        if rest is not None and rest.num_rows:
            yield block(rest, np.zeros(1, np.int64))

    return materialize(rows.repartition(*keep).sortWithinPartitions(*keep).mapInArrow(run, schema), "id-blocks")


class Vectors:
    """The vectors that a block needs, by ascending id."""

    def __init__(self, table, dim: int) -> None:
        import pyarrow.compute as pc
        ids = np.asarray(table.column("vec_id"), np.int64)
        order = np.argsort(ids, kind="stable")
        vecs = table.column("vec").combine_chunks()
        size = np.asarray(pc.list_value_length(vecs), np.int64)
        flat = pc.list_flatten(vecs)
        row = np.repeat(np.arange(len(ids)), size)
        col = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        mine = col < dim
        self.null = np.ones((len(ids), dim), bool)
        self.null[row[mine], col[mine]] = np.asarray(flat.is_null())[mine]
        self.null = self.null[order]
        self.vecs = np.zeros((len(ids), dim))
        self.vecs[row[mine], col[mine]] = np.asarray(flat.fill_null(0.0))[mine]
        self.vecs, self.ids = self.vecs[order], ids[order]
        self.some_null = bool(self.null.any())

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and number of each id's vectors."""
        low = np.searchsorted(self.ids, ids, "left")
        return low, np.searchsorted(self.ids, ids, "right") - low

    def apply(self, work: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray | None]:
        """``work`` on the vectors, and where its result depends on a null element."""
        out = work(self.vecs)
        return out, np.isnan(work(np.where(self.null, np.nan, 0.0))) if self.some_null else None


def _lists(x: np.ndarray, null: np.ndarray | None = None, missing: np.ndarray | None = None):
    """A matrix as an Arrow column of lists; ``null``: elements, ``missing``: rows."""
    import pyarrow as pa
    flat = pa.array(np.ascontiguousarray(x, float).ravel(), pa.float64(), mask=None if null is None else null.ravel())
    ends = np.arange(len(x) + 1, dtype=np.int64) * x.shape[1]
    if missing is None or not missing.any():
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=pa.array(missing))


def _with_vectors(rows: DataFrame, emb: DataFrame, keep: Sequence[str], out: Sequence[T.StructField],
                  work: Callable[[Vectors, np.ndarray, np.ndarray], list], dim: int) -> DataFrame:
    """``keep`` and the columns ``out`` per key of ``rows(keep..., _ids)``. ``work(vectors,
    ptr, ids)`` gets some keys' ids and gives the columns' values; a first
    one named ``__at`` says which key each value belongs to."""
    blocks = rows if "need" in rows.columns else _pack(rows, keep)
    kinds = {f.name: f.dataType.elementType for f in blocks.schema.fields if f.name in keep}
    schema = T.StructType([*[T.StructField(c, kinds[c]) for c in keep], *[f for f in out if f.name != "__at"]])
    placed = out[0].name == "__at"
    need = (blocks.select(F.col("block").alias("at"), F.explode("need").alias("vec_id"))
            .join(emb.filter("vec IS NOT NULL").select("vec_id", "vec"), "vec_id").select("at", "vec_id", "vec"))

    def run(left, right):
        import pyarrow as pa
        import pyarrow.compute as pc
        made, vectors = [], Vectors(right, dim)
        for b in range(left.num_rows):
            one = left.slice(b, 1)
            ptr, ids = (np.asarray(pc.list_flatten(one.column(c)).combine_chunks()) for c in ("ptr", "ids"))
            keys = [pc.list_flatten(one.column(c)).combine_chunks() for c in keep]
            for a in range(0, len(ptr) - 1, CHUNK):
                z = min(a + CHUNK, len(ptr) - 1)
                got = work(vectors, ptr[a:z + 1] - ptr[a], ids[ptr[a]:ptr[z]])
                mine = [k.slice(a, z - a) for k in keys]
                if placed:
                    mine = [k.take(pa.array(got[0])) for k in mine]
                    got = got[1:]
                made.append(pa.table([*mine, *got], schema.names))
        return pa.concat_tables(made)

    return blocks.groupBy("block").cogroup(need.groupBy("at")).applyInArrow(run, schema)


_VEC = T.ArrayType(T.DoubleType())


def _field_ids(df: DataFrame, slots: Sequence[tuple[str, int]], index: Index | None, vocab: DataFrame | None,
               keep: Sequence[str]) -> DataFrame:
    """``keep + (_ids)``: per row the rows of the weights table of each slot, a slot
    being a column and the number that picks its row."""
    if vocab is None:
        return df.select(*keep, F.array(*[index(F.col(c), no) for c, no in slots]).alias("_ids"))
    cols = [c for c in dict.fromkeys(c for c, _ in slots) if c not in keep]
    entries = [F.struct(F.lit(i).alias("_at"), F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
               for i, (c, _) in enumerate(slots)]
    long = df.select(*keep, *cols).select(*keep, F.explode(F.array(*entries)).alias("_e")).select(*keep, "_e.*")
    v = vocab.select("field", F.col("value").cast("string").alias("value"), F.col("idx").cast("long").alias("vec_id"))
    # one number per row and slot is brought together, no vector
    wide = long.join(v, ["field", "value"], "left").groupBy(*keep).agg(
        *[F.max(F.when(F.col("_at") == i, F.col("vec_id"))).alias(f"_i{i}") for i in range(len(slots))])
    return wide.select(*keep, F.array(*[f"_i{i}" for i in range(len(slots))]).alias("_ids"))


def _slot_places(vectors: Vectors, ptr: np.ndarray, ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors of each key's ``width`` slots, and which exist."""
    some = ids[ptr[:-1, None] + np.arange(width)]
    low, n = vectors.find(some.ravel())
    ok = n > 0
    return np.where(ok, low, 0).reshape(some.shape), ok.reshape(some.shape)


def _pick(vecs: np.ndarray, at: np.ndarray) -> np.ndarray:
    return vecs[at] if len(vecs) else np.zeros((len(at), vecs.shape[1]))


def lookup_fields(df: DataFrame, emb: DataFrame, fields: Sequence[str], n: int | None = None,
                  keep: Sequence[str] = ("row_id",), vocab: DataFrame | None = None) -> DataFrame:
    """One vector column ``v_<field>`` per single-valued field, found by hash
    (``n`` rows of weights) or by the index of a vocabulary ``vocab(field,
    value, idx)``. A null or unknown value gives a null vector and keeps the
    row; ``keep`` must identify a row."""
    width = len(fields)

    def work(vectors, ptr, ids):
        at, ok = _slot_places(vectors, ptr, ids, width)
        return [_lists(*vectors.apply(lambda v: _pick(v, at[:, i])), ~ok[:, i]) for i in range(width)]

    rows = _field_ids(df, [(f, i) for i, f in enumerate(fields)], hashed(n) if n else None, vocab, keep)
    return _with_vectors(rows, emb, keep, [T.StructField(f"v_{f}", _VEC) for f in fields], work, _dim(emb))


# ------------------------------------------------------------------ vector helpers
def vadd(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def vsub(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def vmul(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def vscale(a: Column, s: Column) -> Column:
    return F.transform(a, lambda x: x * s)


def vdot(a: Column, b: Column) -> Column:
    return F.aggregate(vmul(a, b), F.lit(0.0), lambda acc, x: acc + x)


def vsum_many(vs: Sequence[Column]) -> Column:
    out = vs[0]
    for v in vs[1:]:
        out = vadd(out, v)
    return out


def summarize(v: Column, prefix: str = "") -> list[Column]:
    """Sum of the elements, of their squares, and of each element times its
    1-based position, which tells reordered or transposed vectors apart."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda acc, y: acc + y)
    return [total(v).alias(f"{prefix}vsum"), total(vmul(v, v)).alias(f"{prefix}vsq"),
            total(F.transform(v, lambda x, i: x * (i + 1))).alias(f"{prefix}vpos")]


# ------------------------------------------------------------------ N01
def _by_row(x: np.ndarray, row: np.ndarray, rows: int, op: np.ufunc = np.add) -> np.ndarray:
    """Sums (or another reduction) of the entries of ``x`` by ascending ``row``."""
    out = np.zeros((rows, *x.shape[1:]))
    if len(row):
        edge = np.flatnonzero(np.concatenate(([True], np.diff(row) != 0)))
        out[row[edge]] = op.reduceat(x, edge)
    return out


def _spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and place inside it, each entry repeated ``count`` times."""
    at = np.repeat(np.arange(len(count)), count)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)


def mean_pool(df: DataFrame, emb: DataFrame, cell: str, n: int, field_no: int = 0,
              row_id: str = "row_id", width: int | None = None, pad: str = "zero",
              missing: str = "-1") -> DataFrame:
    """Average of a multi-valued field's token vectors. The denominator is
    the slot width including padding (``pad='zero'``: pad slots are zero
    vectors) or the token count (``pad='skip'``). ``width`` defaults to the
    longest cell (one aggregate of the blocks). Output ``(row_id, pooled)``."""
    toks = cell_tokens(cell, " ", missing)
    if width is None:
        width = df.agg(F.max(F.size(toks))).first()[0] or 1
    ids = F.transform(toks, lambda t: vec_id(t.try_cast("long"), field_no, n))

    def work(vectors, ptr, ids):
        rows = len(ptr) - 1
        low, count = vectors.find(ids)
        e, o = _spread(count)
        at, row = low[e] + o, np.repeat(np.arange(rows), np.diff(ptr))[e]
        total, k = _by_row(_pick(vectors.vecs, at), row, rows), np.bincount(row, minlength=rows)
        null = None
        if vectors.some_null:
            null = (_by_row(_pick(~vectors.null, at), row, rows) == 0) & (k > 0)[:, None]
        return [_lists(total * (1.0 / (float(width) if pad == "zero" else np.maximum(k, 1.0)[:, None])), null)]

    return _with_vectors(df.select(row_id, ids.alias("_ids")), emb, [row_id], [T.StructField("pooled", _VEC)], work, _dim(emb))


# ------------------------------------------------------------------ N02
def fm_second_order(vecs: Sequence[Column]) -> Column:
    """Per dimension ``0.5 * ((sum v)^2 - sum v^2)``."""
    s = vsum_many(list(vecs))
    q = vsum_many([vmul(v, v) for v in vecs])
    return F.zip_with(s, q, lambda a, b: F.lit(0.5) * (a * a - b))


def fm_interaction(df: DataFrame, emb: DataFrame, fields: Sequence[str], n: int,
                   keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """``keep + (fm)``: :func:`fm_second_order` of the fields' vectors; null if one is
    missing."""
    width = len(fields)

    def work(vectors, ptr, ids):
        at, ok = _slot_places(vectors, ptr, ids, width)

        def second(vecs):
            each = [_pick(vecs, at[:, i]) for i in range(width)]
            return 0.5 * (sum(each) ** 2 - sum(v * v for v in each))

        return [_lists(*vectors.apply(second), ~ok.all(1))]

    rows = _field_ids(df, [(f, i) for i, f in enumerate(fields)], hashed(n), None, keep)
    return _with_vectors(rows, emb, keep, [T.StructField("fm", _VEC)], work, _dim(emb))


def fm_first_order(weights: Sequence[Column]) -> Column:
    """Sum of the one-dimensional weights of the fields; a missing one adds 0."""
    return sum((F.coalesce(w, F.lit(0.0)) for w in weights), F.lit(0.0))


# ------------------------------------------------------------------ N03 / N04 / N07
def pairs(fields: Sequence[str], include_self: bool = False) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(fields) for j, b in enumerate(fields)
            if (j > i or (include_self and j == i))]


def hadamard(a: Column, b: Column) -> Column:
    return vmul(a, b)


def outer(a: Column, b: Column) -> Column:
    """Flattened k x k outer product a b^T."""
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: x * y)))


def pair_diff(a: Column, b: Column) -> Column:
    """[a, a - b, b]."""
    return F.concat(a, vsub(a, b), b)


def hadamard_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """:func:`hadamard` of the rows of two matrices."""
    return a * b


def outer_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """:func:`outer` of the rows of two matrices."""
    return (a[:, :, None] * b[:, None, :]).reshape(len(a), -1)


def pair_diff_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """:func:`pair_diff` of the rows of two matrices."""
    return np.hstack([a, a - b, b])


def summarize_rows(x: np.ndarray) -> np.ndarray:
    """:func:`summarize` of each row: sum, sum of squares, sum times position."""
    return np.stack([x.sum(1), np.einsum("ij,ij->i", x, x), x @ np.arange(1.0, x.shape[1] + 1)], 1)


def pairwise_sums(df: DataFrame, emb: DataFrame, fields: Sequence[str], n: int,
                  op: Callable[[np.ndarray, np.ndarray], np.ndarray], keep: Sequence[str] = ("row_id",),
                  include_self: bool = False) -> DataFrame:
    """One row per (row, field pair): ``keep, pair`` and the :func:`summarize` sums of
    ``op(v_a, v_b)``, null if a vector is missing. ``op`` makes the whole vectors of
    some rows at a time; they end with their sums, no long one is stored or moved."""
    ps = [(fields.index(a), fields.index(b)) for a, b in pairs(fields, include_self)]
    names = [f"{fields[a]}_{fields[b]}" for a, b in ps]

    def sums(vecs, at, ok, i, j):
        out = np.zeros((len(at), 3))
        step = 1
        k = np.flatnonzero(ok[:, i] & ok[:, j])
        a = 0
        while a < len(k):
            some = k[a:a + step]
            x = op(vecs[at[some, i]], vecs[at[some, j]])
            out[some] = summarize_rows(x)
            a, step = a + len(some), max(1, _ELEMENTS // max(x.shape[1], 1))
        return out

    def work(vectors, ptr, ids):
        import pyarrow as pa
        at, ok = _slot_places(vectors, ptr, ids, len(fields))
        rows = len(at)
        cols = []
        for i, j in ps:
            x, null = vectors.apply(lambda v: sums(v, at, ok, i, j))
            gone = ~(ok[:, i] & ok[:, j])
            cols.append((x, gone[:, None] | (np.zeros(x.shape, bool) if null is None else null)))
        x, null = (np.stack([c[k] for c in cols], 1).reshape(rows * len(ps), 3) for k in (0, 1))
        return [np.repeat(np.arange(rows), len(ps)), pa.array(np.tile(names, rows), pa.string()),
                *[pa.array(np.ascontiguousarray(x[:, c]), mask=null[:, c]) for c in range(3)]]

    rows = _field_ids(df, [(f, i) for i, f in enumerate(fields)], hashed(n), None, keep)
    out = [T.StructField("__at", T.LongType()), T.StructField("pair", T.StringType()),
           *[T.StructField(c, T.DoubleType()) for c in ("vsum", "vsq", "vpos")]]
    return _with_vectors(rows, emb, keep, out, work, _dim(emb))


# ------------------------------------------------------------------ N05
def ffm_interaction(df: DataFrame, emb: DataFrame, fields: Sequence[str], n: int,
                    keep: Sequence[str] = ("row_id",), include_self: bool = False,
                    per_field: bool = False) -> DataFrame:
    """Field-aware interaction: field i's value has one vector per target
    field k (row ``vec_id(value, i*F + k)`` of the weights table); the output
    sums ``v[i->k] * v[k->i]`` over pairs i<k (i<=k with ``include_self``).
    Output ``keep + (ffm)``; with ``per_field`` one vector ``ffm_<field>`` per
    field, the sum over that field's pairs. A null value adds nothing and
    keeps the row. One join with the weights for any number of fields."""
    nf = len(fields)
    used = [(i, k) for i in range(nf) for k in range(nf) if include_self or i != k]
    slot = {p: i for i, p in enumerate(used)}
    pair = [(i, k) for i in range(nf) for k in range(i if include_self else i + 1, nf)]
    groups = [[p for p in pair if j in p] for j in range(nf)] if per_field else [pair]

    def work(vectors, ptr, ids):
        at, ok = _slot_places(vectors, ptr, ids, len(used))

        def total(vecs, mine):
            out = np.zeros((len(at), vecs.shape[1]))
            for i, k in mine:
                a, b = slot[i, k], slot[k, i]
                some = np.flatnonzero(ok[:, a] & ok[:, b])
                out[some] += vecs[at[some, a]] * vecs[at[some, b]]
            return out

        return [_lists(*vectors.apply(lambda v: total(v, mine))) for mine in groups]

    rows = _field_ids(df, [(fields[i], i * nf + k) for i, k in used], hashed(n), None, keep)
    names = [f"ffm_{f}" for f in fields] if per_field else ["ffm"]
    return _with_vectors(rows, emb, keep, [T.StructField(c, _VEC) for c in names], work, _dim(emb))


# ------------------------------------------------------------------ N06
#: scores of the rows of a matrix of queries and one of keys
Scorer = Callable[[np.ndarray, np.ndarray], np.ndarray]


def dot_scorer(q: np.ndarray, k: np.ndarray) -> np.ndarray:
    """``q.k``."""
    return np.einsum("ij,ij->i", q, k)


def linear_scorer(weights: Sequence[float], bias: float = 0.0) -> Scorer:
    """Scorer ``w . [q, k, q - k, q * k] + bias`` for :func:`attention_pool`."""
    return lambda q, k: np.hstack([q, k, q - k, q * k]) @ np.asarray(weights, float) + bias


#: weights (inputs x outputs) and biases of a dense layer
Layer = tuple[np.ndarray, np.ndarray]


def mlp_layers(table: DataFrame) -> list[Layer]:
    """Dense layers from a weights table ``(layer, i, j, w)``: input ``i`` to output
    ``j``, ``i`` = -1 for the bias. A few thousand rows, by the layers' sizes."""
    got: dict[int, list] = {}
    for r in table.collect():
        got.setdefault(r["layer"], []).append((r["i"], r["j"], r["w"]))
    out = []
    for layer in sorted(got):
        rows = got[layer]
        w = np.zeros((2 + max(i for i, _, _ in rows), 1 + max(j for _, j, _ in rows)))
        for i, j, x in rows:
            w[i, j] = x  # the bias is the last row
        out.append((w[:-1], w[-1]))
    return out


def mlp_scorer(layers: Sequence[Layer]) -> Scorer:
    """Dense layers over ``[q, k, q - k, q * k]``, sigmoid after each but the last.
    The first layer is taken apart by its four inputs, which are never stacked."""
    layers = [(np.asarray(w, float), np.asarray(b, float)) for w, b in layers]

    def score(q: np.ndarray, k: np.ndarray) -> np.ndarray:
        dim = q.shape[1]
        w, bias = layers[0]
        one, two, less, times = (w[i * dim:(i + 1) * dim] for i in range(4))
        x = q @ (one + less) + k @ (two - less) + (q * k) @ times + bias
        for w, bias in layers[1:]:
            x = 0.5 * (1.0 + np.tanh(0.5 * x)) @ w + bias
        return x[:, 0]

    return score


def attention_pool(df: DataFrame, emb: DataFrame, query_field: str, cell: str, n: int,
                   row_id: str = "row_id", query_no: int = 0, key_no: int = 1,
                   missing: str = "-1", scorer: Scorer | None = None,
                   mlp: Sequence[Layer] | None = None) -> DataFrame:
    """Target attention: the query field's vector scores each token vector of
    the multi-valued cell by ``scorer(q, k)`` (default ``q.k``) or by the dense
    layers ``mlp`` (see :func:`mlp_scorer`), divided by ``sqrt(dim)``; softmax over
    the row's tokens (padding slots are masked out, so they get no weight); output
    the weighted sum of token vectors, zeros for an empty cell."""
    dim = _dim(emb)
    score = mlp_scorer(mlp) if mlp else scorer or dot_scorer
    # a key's ids come in groups of a query and a token
    query = vec_id(F.col(query_field), query_no, n)
    both = F.flatten(F.transform(cell_tokens(cell, " ", missing),
                                 lambda t: F.array(query, vec_id(t.try_cast("long"), key_no, n))))

    def work(vectors, ptr, ids):
        rows = len(ptr) - 1
        low, count = vectors.find(ids)
        e, o = _spread(count[::2] * count[1::2])
        q, k = low[::2][e] + o % np.maximum(count[::2][e], 1), low[1::2][e] + o // np.maximum(count[::2][e], 1)
        row = np.repeat(np.arange(rows), np.diff(ptr) // 2)[e]
        if vectors.some_null:  # no score from null elements
            whole = ~vectors.null.any(1)
            some = whole[q] & whole[k]
            q, k, row = q[some], k[some], row[some]
        keys = _pick(vectors.vecs, k)
        s = score(_pick(vectors.vecs, q), keys) / math.sqrt(dim) if len(q) else np.empty(0)
        if mlp and np.isnan(s).any():
            some = ~np.isnan(s)
            keys, row, s = keys[some], row[some], s[some]
        # the row's largest score, over its own tokens, keeps the exponentials finite
        with np.errstate(invalid="ignore"):
            w = np.exp(s - _by_row(s, row, rows, np.maximum)[row])
        t = np.where(np.bincount(row, minlength=rows) > 0, np.bincount(row, w, rows), 1.0)
        total = _by_row(w[:, None] * keys, row, rows) * (1.0 / t)[:, None]
        return [_lists(total)]

    return _with_vectors(df.select(row_id, both.alias("_ids")), emb, [row_id], [T.StructField("att", _VEC)], work, dim)

"""Factorisation machine classifier of second order, trained on Spark.

Model, starting values and steps are those of MLlib's ``FMClassifier`` (``adamW``,
all rows in every step). MLlib keeps a vector object per training row, which no longer
fits into memory on a large table, and makes a dense gradient per row. Here rows are
written once as blocks of sparse arrays; a step reads the blocks, sums their gradients
with array operations and adds the tasks' sums per feature. Only the model's weights,
as large as the vocabulary, pass through the driver.

Cases: labels other than 0 and 1 and features that are not finite are refused, as by
MLlib; rows without entries score by the bias; without training rows the starting
values are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import FMClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.session import materialize

#: rows of one block, and rows whose entries are expanded at a time
BLOCK_ROWS = 20_000
_CHUNK = 4096
#: rows that one task of a step reads
TASK_ROWS = 200_000


# ------------------------------------------------------------------ array maths
def _csr(vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``indptr, features, values`` of an Arrow array of unwrapped vectors, sparse or dense."""
    if vectors.null_count:
        raise ValueError("a row has no features")
    values, indices = vectors.field("values"), vectors.field("indices")
    indptr = np.concatenate(([0], np.cumsum(values.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
    row = np.repeat(np.arange(len(vectors)), np.diff(indptr))
    feature = np.arange(indptr[-1]) - indptr[row]  # a dense vector has a value for each place
    feature[vectors.field("type").to_numpy(zero_copy_only=False)[row] == 0] = indices.flatten().to_numpy()
    return indptr, feature.astype(np.int32), values.flatten().to_numpy()


def margins(w: list[np.ndarray], lin: np.ndarray, bias: float, indptr: np.ndarray, feature: np.ndarray,
            x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Margins of rows and their sums of x v, for each latent column of ``w``."""
    rows = len(indptr) - 1
    some = np.flatnonzero(np.diff(indptr))  # a row may have no entries

    def row_sums(v: np.ndarray) -> np.ndarray:
        out = np.zeros(rows)
        if len(some):
            out[some] = np.add.reduceat(v, indptr[some])
        return out

    one, m, sums = x * lin[feature], np.full(rows, bias), []
    for column in w:
        xv = x * column[feature]
        sums.append(row_sums(xv))
        one -= 0.5 * xv * xv
        m += 0.5 * sums[-1] * sums[-1]
    return m + row_sums(one), sums


def columns(w: np.ndarray) -> list[np.ndarray]:
    """One contiguous array per latent column: gathers and sums over one are several
    times faster than over rows of a few values."""
    return [np.ascontiguousarray(w[:, c]) for c in range(w.shape[1])]


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * m))


def add_gradient(g: np.ndarray, w: np.ndarray, lin: np.ndarray, bias: float, labels: np.ndarray,
                 indptr: np.ndarray, feature: np.ndarray, x: np.ndarray) -> None:
    """Add the gradient of the rows' log loss to ``g``: latent and first-order values
    per feature, then a row for the bias."""
    n, k = w.shape
    cols = columns(w)
    for a in range(0, len(labels), _CHUNK):
        z = min(a + _CHUNK, len(labels))
        at, lo, hi = indptr[a:z + 1] - indptr[a], indptr[a], indptr[z]
        f, v = feature[lo:hi].astype(np.intp), x[lo:hi]
        m, s = margins(cols, lin, bias, at, f, v)
        kappa = sigmoid(m) - labels[a:z]
        row = np.repeat(np.arange(z - a), np.diff(at))
        t = kappa[row] * v
        own = np.bincount(f, t * v, n)
        for c in range(k):
            g[:n, c] += np.bincount(f, t * s[c][row], n) - own * w[:, c]
        g[:n, k] += np.bincount(f, t, n)
        g[n, k] += kappa.sum()


# ------------------------------------------------------------------ blocks
def make_blocks(rows: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """``n`` rows each with their ``labels, indptr, features, vals`` as bytes: a step
    hands whole blocks to the tasks' Python."""
    def build(batches):
        import pyarrow as pa

        def block(parts):
            labels, indptr, feature, x = (np.concatenate(p) for p in zip(*parts))
            if not (np.isin(labels, (0.0, 1.0)).all() and np.isfinite(x).all()):
                raise ValueError("a label is not 0 or 1, or a feature is not finite")
            made = (labels, np.concatenate(([0], np.cumsum(indptr))), feature, x)
            return pa.RecordBatch.from_arrays([pa.array([len(labels)], pa.int64()), *[pa.array([c.tobytes()]) for c in made]],
                                              ["n", "labels", "indptr", "features", "vals"])

        parts, held = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(a, BLOCK_ROWS)
                indptr, feature, x = _csr(some.column("v"))
                parts.append((some.column("y").to_numpy(zero_copy_only=False).astype("float64"), np.diff(indptr), feature, x))
                held += some.num_rows
                if held >= BLOCK_ROWS:
                    yield block(parts)
                    parts, held = [], 0
        if parts:
            yield block(parts)

    some = rows.select(F.col(label).cast("double").alias("y"), F.unwrap_udt(F.col(features)).alias("v"))
    parts = max(3 * rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    return some.repartition(parts).mapInArrow(build, "n long, labels binary, indptr binary, features binary, vals binary")


def gradient(blocks: DataFrame, w: np.ndarray, lin: np.ndarray, bias: float) -> np.ndarray:
    """The gradient summed over all rows of ``blocks``, one row of sums per feature."""
    n, k = w.shape
    names = [f"g{c}" for c in range(k + 1)]

    def run(batches):
        import pyarrow as pa
        g = np.zeros((n + 1, k + 1))
        for batch in batches:
            for b in range(batch.num_rows):
                col = lambda c, t: np.frombuffer(batch.column(c)[b].as_buffer(), t)
                add_gradient(g, w, lin, bias, col("labels", "float64"), col("indptr", "int64"),
                             col("features", "int32"), col("vals", "float64"))
        held = np.flatnonzero(g.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(held), *[pa.array(g[held, c]) for c in range(k + 1)]], ["feature", *names])

    sums = (blocks.mapInArrow(run, "feature long, " + ", ".join(f"{c} double" for c in names))
            .groupBy("feature").agg(*[F.sum(c).alias(c) for c in names]).collect())
    out = np.zeros((n + 1, k + 1))
    for r in sums:
        out[r["feature"]] = r[1:]
    return out


# ------------------------------------------------------------------ model
@dataclass(frozen=True)
class FMModel:
    """Latent values ``factors[feature, k]``, first-order values and bias; ``steps``: how many were made."""
    factors: np.ndarray
    linear: np.ndarray
    intercept: float
    features: str = "features"
    steps: int = 0

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the vector ``probability`` of both classes."""
        w, lin, bias = columns(self.factors), self.linear, self.intercept

        @F.arrow_udf("double")
        def positive(vectors):
            import pyarrow as pa
            return pa.array(sigmoid(margins(w, lin, bias, *_csr(vectors))[0]))

        p = positive(F.unwrap_udt(F.col(self.features)))
        return rows.withColumn("_p", p).withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p"), F.col("_p")))).drop("_p")


@dataclass(frozen=True)
class FM:
    """Training parameters, named as MLlib's."""
    factor_size: int = 4
    step_size: float = 0.02
    reg: float = 1e-6
    max_iter: int = 100
    tol: float = 1e-6
    label: str = "label"
    features: str = "features"
    seed: int = 2018

    def start(self, rows: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
        """MLlib's own starting values: its model after no step."""
        m = FMClassifier(labelCol=self.label, featuresCol=self.features, factorSize=self.factor_size, seed=self.seed,
                         maxIter=0).fit(rows.limit(1))
        return m.factors.toArray(), m.linear.toArray(), m.intercept

    def fit(self, rows: DataFrame) -> FMModel:
        """AdamW over all rows until a step moves the weights by less than ``tol`` of
        their norm, or ``max_iter`` steps."""
        w, lin, bias = self.start(rows)
        blocks = materialize(make_blocks(rows, self.features, self.label), "fm-blocks")
        total = blocks.agg(F.sum("n")).first()[0]
        n, k = w.shape
        both = np.zeros((n + 1, k + 1))
        both[:n, :k], both[:n, k], both[n, k] = w, lin, bias
        m, v, steps = np.zeros_like(both), np.zeros_like(both), 0
        for t in range(1, self.max_iter + 1 if total else 1):
            g = gradient(blocks, both[:n, :k], both[:n, k], float(both[n, k])) / total
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            rate = m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            last, both, steps = both, both - self.step_size * rate - self.reg * both, t
            # the first step is never the last one
            if t > 1 and np.linalg.norm(both - last) < self.tol * max(float(np.linalg.norm(both)), 1.0):
                break
        return FMModel(both[:n, :k], both[:n, k], float(both[n, k]), self.features, steps)

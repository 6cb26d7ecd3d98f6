"""Numeric column expressions: digamma, right-closed digitize, sigmoid,
softmax, logit, bucketing, z-score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Percentile edges and fixed bucket edges of the digitize
# features, and the cap / scale of the information-score bucket.
PERCENTILE_EDGES = [0, 20, 35, 50, 65, 85, 100]
UID_COUNT_EDGES = [1, 2, 4, 6, 8, 10, 16, 27, 50]
UID_CONVERT_EDGES = [-1, 0, 0.1, 0.3, 0.5, 0.7, 1]
PMI_CAP = 1.5


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def digamma(x) -> Column:
    """psi(x) for x > 0: shift up six times with psi(x) = psi(x+1) - 1/x,
    then the asymptotic series."""
    x = _c(x).cast("double")
    shift = sum((F.lit(1.0) / (x + F.lit(float(i))) for i in range(6)), F.lit(0.0))
    y = x + F.lit(6.0)
    y2 = y * y
    y4 = y2 * y2
    series = (F.log(y) - F.lit(0.5) / y - F.lit(1.0) / (F.lit(12.0) * y2)
              + F.lit(1.0) / (F.lit(120.0) * y4) - F.lit(1.0) / (F.lit(252.0) * y4 * y2))
    return series - shift


def digitize_right(x, edges: Sequence[float]) -> Column:
    """numpy ``digitize(x, edges, right=True)``: number of edges strictly
    below x (0 when x <= first edge)."""
    x = _c(x)
    return sum((F.when(x > F.lit(float(e)), 1).otherwise(0) for e in edges), F.lit(0))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def softmax2_pos(x0, x1) -> Column:
    """exp(x1) / (exp(x0) + exp(x1)), stable form."""
    x0, x1 = _c(x0), _c(x1)
    mx = F.greatest(x0, x1)
    e0, e1 = F.exp(x0 - mx), F.exp(x1 - mx)
    return e1 / (e0 + e1)


def logit(p, eps: float = 1e-7) -> Column:
    p = F.least(F.greatest(_c(p), F.lit(eps)), F.lit(1.0 - eps))
    return F.log(p / (F.lit(1.0) - p))


def pmi_bucket(x, xmin, cap: float = PMI_CAP) -> Column:
    """Shift by the minimum, cap, one decimal (half-up), times ten -> int."""
    v = F.least(_c(x) - _c(xmin), F.lit(cap))
    return F.round(v * F.lit(10.0), 0).cast("int")


def zscore(x, mean, std) -> Column:
    """(x - mean) / std with a zero std replaced by 1."""
    s = F.when(_c(std) == 0, F.lit(1.0)).otherwise(_c(std))
    return (_c(x) - _c(mean)) / s

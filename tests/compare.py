"""Order-insensitive comparison of a Spark result and a pandas frame."""

import math

import pandas as pd


def norm(v):
    if v is None or v is pd.NA:
        return "None"
    if isinstance(v, float):
        return "None" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def frame(df):
    """A Spark result as pandas, whole numbers with nulls kept whole."""
    out = df.toPandas()
    for f in df.schema.fields:
        if f.dataType.typeName() in ("long", "integer", "short", "byte") and out[f.name].dtype.kind in "fO":
            out[f.name] = out[f.name].astype("Int64")
    return out


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted("|".join(norm(x) for x in r) for r in pdf[cols].itertuples(index=False))


def same(a, b):
    ca, ra = rows(a)
    cb, rb = rows(b)
    assert ca == cb, (ca, cb)
    assert len(ra) == len(rb), (len(ra), len(rb))
    diff = [(x, y) for x, y in zip(ra, rb) if x != y][:3]
    assert not diff, diff

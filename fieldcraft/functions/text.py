"""Multi-valued cell helpers (tokenising, lenient numeric parse)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_CELL = "-1"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(cell, sep: str = " ") -> Column:
    """Split on one literal separator (``str.split(' ')``): empty pieces kept."""
    return F.split(_c(cell), _regex_escape(sep))


def tokens_ws(cell) -> Column:
    """Whitespace split (``str.split()``): no empty tokens, empty cell -> []."""
    return F.filter(F.split(F.trim(_c(cell)), r"\s+"), lambda t: t != F.lit(""))


def cell_tokens(cell, sep: str = " ", missing: str = MISSING_CELL) -> Column:
    """Tokens of a multi-valued cell; the missing marker gives an empty array."""
    c = _c(cell)
    return F.when(c.isNull() | (c == F.lit(missing)), F.array().cast("array<string>")) \
            .otherwise(tokens(c, sep))


def lenient_int(x) -> Column:
    """``int(float(v))`` (64-bit) or null when the text is not a number, not
    finite, or outside the 64-bit range."""
    d = _c(x).try_cast("double")
    return F.when(~F.isnan(d), d).try_cast("bigint")


def numeric_tokens(cell, sep: str = " ") -> Column:
    """Tokens parsed leniently as ints, non-numeric and zero dropped."""
    return F.filter(F.transform(tokens(cell, sep), lenient_int),
                    lambda t: t.isNotNull() & (t != F.lit(0)))


def token_count(cell, missing: str = MISSING_CELL) -> Column:
    """Whitespace token count, the missing marker counting 0."""
    c = _c(cell)
    return F.when(c == F.lit(missing), F.lit(0)).otherwise(F.size(tokens_ws(c)))


def distinct_token_count(cell, sep: str = " ") -> Column:
    return F.size(F.array_distinct(tokens(cell, sep)))


def cross_key(*cols) -> Column:
    """Cross columns into one unambiguous string key: every value carries its
    length, and null differs from any text, so ('a_b', 'c') and ('a', 'b_c')
    or null and 'nan' never share a key."""
    def part(c) -> Column:
        v = _c(c).cast("string")
        return F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("~"))
    return F.concat(*[part(c) for c in cols])


def _regex_escape(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in s)

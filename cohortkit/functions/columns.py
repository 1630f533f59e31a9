"""Scalar and row-wise column expressions.

All helpers return ``pyspark.sql.Column`` objects built from built-in
functions only, so they stay inside whole-stage codegen.  Null handling
follows pandas' row-wise reductions (``skipna``) where noted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "part", "numeric_part", "first_token", "rest_tokens", "bool_text", "text_or",
    "lookup", "clip_lower", "cross_text", "null_count", "known_count", "row_sum", "row_mean",
    "row_std", "row_max", "row_min", "count_positive", "is_zero", "safe_ratio", "finite_or_null",
    "strength_label", "skew_label", "weighted_sum",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def part(c: str | Column, sep: str, index: int) -> Column:
    """``index``-th (0-based) piece of ``c`` split on literal ``sep``; null when
    the piece does not exist or ``c`` is null (pandas ``str.split(expand=True)``)."""
    pattern = "\\Q" + sep + "\\E"
    return F.get(F.split(col_of(c), pattern), index)


def numeric_part(c: str | Column, sep: str, index: int) -> Column:
    """Piece parsed as double; unparsable -> null (``to_numeric(errors='coerce')``)."""
    return part(c, sep, index).try_cast("double")


def first_token(c: str | Column, sep: str = " ") -> Column:
    """Text before the first ``sep`` (whole text when absent)."""
    return F.get(F.split(col_of(c), "\\Q" + sep + "\\E", 2), 0)


def rest_tokens(c: str | Column, sep: str = " ") -> Column:
    """Text after the first ``sep``; null when there is no separator."""
    return F.get(F.split(col_of(c), "\\Q" + sep + "\\E", 2), 1)


def bool_text(c: str | Column, missing: str | None = "Unknown") -> Column:
    """Boolean rendered the way pandas stringifies it: ``True``/``False``."""
    b = col_of(c)
    out = F.when(b, F.lit("True")).when(~b, F.lit("False"))
    return out if missing is None else F.coalesce(out, F.lit(missing))


def text_or(c: str | Column, missing: str = "Unknown") -> Column:
    """Cast to string and fill nulls with ``missing``; booleans become True/False."""
    return F.coalesce(col_of(c).cast("string"), F.lit(missing))


def lookup(c: str | Column, mapping: Mapping) -> Column:
    """Literal dictionary lookup; unmapped or null keys give null."""
    if not mapping:
        return F.lit(None)
    pairs = []
    for k, v in mapping.items():
        pairs.extend([F.lit(k), F.lit(v)])
    return F.try_element_at(F.create_map(*pairs), col_of(c))


def clip_lower(c: str | Column, lower: float) -> Column:
    """``Series.clip(lower=...)``: null stays null (``greatest`` would not)."""
    x = col_of(c)
    return F.when(x < F.lit(lower), F.lit(lower).cast("double")).otherwise(x.cast("double"))


def cross_text(a: str | Column, b: str | Column, sep: str = "_") -> Column:
    """``a + sep + b``; null when either side is null (pandas string concat)."""
    return F.concat(col_of(a), F.lit(sep), col_of(b))


def null_count(cols: Sequence[str]) -> Column:
    return reduce(lambda x, y: x + y, [F.col(c).isNull().cast("int") for c in cols])


def known_count(cols: Sequence[str]) -> Column:
    return reduce(lambda x, y: x + y, [F.col(c).isNotNull().cast("int") for c in cols])


def row_sum(cols: Sequence[str], min_count: int = 0) -> Column:
    """Row sum skipping nulls; with ``min_count=1`` an all-null row gives null
    (pandas ``sum(axis=1, min_count=1)``), otherwise 0."""
    total = reduce(lambda x, y: x + y, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    if min_count <= 0:
        return total
    return F.when(known_count(cols) >= min_count, total)


def row_mean(cols: Sequence[str]) -> Column:
    """Mean of the non-null values; null when all are null."""
    n = known_count(cols)
    return F.when(n > 0, row_sum(cols) / n)


def row_std(cols: Sequence[str], ddof: int = 1, fill: float | None = 0.0) -> Column:
    """Sample standard deviation over non-null values (two-pass form, so the
    rounding matches a mean-then-deviation computation); fewer than ddof+1
    values give ``fill``."""
    n = known_count(cols)
    mean = row_mean(cols)
    ss = reduce(
        lambda x, y: x + y,
        [F.coalesce((F.col(c).cast("double") - mean) * (F.col(c).cast("double") - mean), F.lit(0.0)) for c in cols],
    )
    std = F.when(n > ddof, F.sqrt(ss / (n - ddof)))
    return std if fill is None else F.coalesce(std, F.lit(fill))


def row_max(cols: Sequence[str]) -> Column:
    return F.greatest(*[F.col(c).cast("double") for c in cols])


def row_min(cols: Sequence[str]) -> Column:
    return F.least(*[F.col(c).cast("double") for c in cols])


def count_positive(cols: Sequence[str]) -> Column:
    """How many of ``cols`` are > 0 (null counts as not positive)."""
    return reduce(lambda x, y: x + y, [F.coalesce(F.col(c) > 0, F.lit(False)).cast("int") for c in cols])


def is_zero(c: str | Column) -> Column:
    """1 when the value equals 0, else 0 (null -> 0)."""
    return F.coalesce(col_of(c) == 0, F.lit(False)).cast("int")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Null-propagating ratio; division by zero gives null instead of an error."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def finite_or_null(c: str | Column) -> Column:
    """Parse as double; NaN and +-inf become null."""
    x = col_of(c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


# P-value banding used by the association report.
P_VERY_STRONG = 1e-20
P_STRONG = 1e-6
P_MODERATE = 0.01
# Fixed value: |skewness| above this is reported as highly skewed.
SKEW_FLAG = 1.5


def strength_label(p: str | Column) -> Column:
    x = col_of(p)
    return (
        F.when(x < P_VERY_STRONG, "VERY STRONG")
        .when(x < P_STRONG, "STRONG")
        .when(x < P_MODERATE, "MODERATE")
        .otherwise("weak")
    )


def skew_label(s: str | Column) -> Column:
    return F.when(F.abs(col_of(s)) > SKEW_FLAG, F.lit("HIGHLY SKEWED")).otherwise(F.lit(""))


def weighted_sum(weights: Mapping[str, float | Column]) -> Column:
    """Linear combination ``sum(w_c * c)`` evaluated left to right."""
    terms = [(w if isinstance(w, Column) else F.lit(float(w))) * F.col(c) for c, w in weights.items()]
    return reduce(lambda x, y: x + y, terms)

"""Feature operators: packed-column decomposition, row-wise statistics,
group sizes and group statistics broadcast back to rows, interaction
columns, categorical finalisation and numeric clean-up.

Group features (sizes, means, max) are computed as one grouped aggregation
per key and joined back (null-safe), not as an unordered window: a window
puts a whole group into one task, while the aggregation combines partial
results on the map side, so a key holding a third of the rows costs the
same as any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions import columns as C
from cohortkit.operators.impute import fill_from_stats, group_stats

__all__ = [
    "split_packed", "split_first", "null_flags", "row_features", "group_size", "group_aggregates",
    "ratio", "cross", "stringify", "clean_numeric", "select_numeric", "map_values",
]


def split_packed(df: DataFrame, col: str, sep: str, outs: Sequence[tuple[str, int, str]],
                 known_flag: str | None = None) -> DataFrame:
    """Split ``col`` on ``sep``.  ``outs`` = (name, piece index, 'string' or
    'double'); numeric pieces that do not parse become null.  ``known_flag``
    adds a 0/1 column telling whether ``col`` was present."""
    new = []
    for name, idx, kind in outs:
        piece = C.part(col, sep, idx)
        new.append((piece.try_cast("double") if kind == "double" else piece).alias(name))
    if known_flag:
        new.append(F.col(col).isNotNull().cast("int").alias(known_flag))
    keep = [F.col(c) for c in df.columns if c not in {n for n, _, _ in outs} | {known_flag}]
    return df.select(*keep, *new)


def split_first(df: DataFrame, col: str, first: str, rest: str, sep: str = " ", missing: str = "Unknown") -> DataFrame:
    """Split once on the first ``sep``: a null input gives ``first=missing``
    and ``rest=NULL``; a single token gives ``rest=missing``."""
    x = F.col(col)
    return df.withColumns({
        first: F.when(x.isNull(), F.lit(missing)).otherwise(C.first_token(x, sep)),
        rest: F.when(x.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(C.rest_tokens(x, sep), F.lit(missing))),
    })


def null_flags(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """``{source: flag_name}`` -> 0/1 indicator of a null source value."""
    return df.withColumns({out: F.col(src).isNull().cast("int") for src, out in cols.items()})


def row_features(df: DataFrame, cols: Sequence[str], prefix: str = "Spend") -> DataFrame:
    """Row-wise statistics over ``cols`` (nulls skipped, as pandas does)."""
    total = C.row_sum(cols)
    return df.withColumns({
        f"{prefix}Mean": C.row_mean(cols),
        f"{prefix}Std": C.row_std(cols, ddof=1, fill=0.0),
        f"{prefix}Max": C.row_max(cols),
        f"{prefix}Min": C.row_min(cols),
        "ServicesUsed": C.count_positive(cols),
        "ZeroSpend": C.is_zero(total),
    })


def group_size(df: DataFrame, key: str, out: str, null_value: float | None = None) -> DataFrame:
    """Number of rows sharing ``key`` on each row.  Rows with a NULL key get
    ``null_value`` (pandas ``key.map(key.value_counts())`` gives NaN there)."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("__stat_" + out))
    joined = df.withColumn(out, F.lit(None).cast("double"))
    joined = fill_from_stats(joined, counts, [key], [out])
    if null_value is not None:
        joined = joined.withColumn(out, F.coalesce(F.col(out), F.lit(float(null_value))))
    return joined


def group_aggregates(df: DataFrame, key: str | Sequence[str], aggs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{out: (func, source)}`` with func in mean/max/min/sum/count computed
    per ``key`` (NULL key is a group) and attached to every row."""
    keys = [key] if isinstance(key, str) else list(key)
    fns = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}
    stats = df.groupBy(*keys).agg(*[fns[f](F.col(src)).cast("double").alias("__stat_" + out) for out, (f, src) in aggs.items()])
    base = df.withColumns({out: F.lit(None).cast("double") for out in aggs})
    return fill_from_stats(base, stats, keys, list(aggs))


def ratio(df: DataFrame, num: str, den: str, out: str, lower: float | None = None) -> DataFrame:
    """``num / clip(den, lower)``, null-propagating."""
    d = C.clip_lower(den, lower) if lower is not None else F.col(den)
    return df.withColumn(out, C.safe_ratio(num, d))


def cross(df: DataFrame, pairs: Mapping[str, tuple[str, str]], sep: str = "_") -> DataFrame:
    """Interaction columns ``{out: (a, b)}`` = ``a + sep + b`` (null if either is)."""
    return df.withColumns({out: C.cross_text(a, b, sep) for out, (a, b) in pairs.items()})


def stringify(df: DataFrame, cols: Sequence[str], missing: str = "Unknown") -> DataFrame:
    """Categoricals as text: booleans become ``True``/``False``, nulls ``missing``."""
    out = {}
    for c in cols:
        if c not in df.columns:
            continue
        if df.schema[c].dataType.typeName() == "boolean":
            out[c] = C.bool_text(c, missing)
        else:
            out[c] = C.text_or(c, missing)
    return df.withColumns(out)


def clean_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Parse to double, turn NaN/inf into null, fill with the column's exact
    median (a column without any value stays null).  The medians are one row,
    attached by a one-row broadcast; nothing runs before the result does."""
    df = df.withColumns({c: C.finite_or_null(c) for c in cols})
    return fill_from_stats(df, group_stats(df, [], medians=cols), [], cols)


def with_gaps(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Those of ``cols`` that ``clean_numeric`` would fill: one counting job over
    a written table, for plans that spare themselves the other medians."""
    counts = df.agg(*[F.count_if(C.finite_or_null(c).isNull()).alias(c) for c in cols]).first()
    return [c for c in cols if counts[c] > 0]


def select_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Numeric columns only; booleans are not numeric here (pandas)."""
    from pyspark.sql.types import NumericType

    keep = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]
    return df.select(*keep)


def map_values(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, C.lookup(col, mapping))


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant fill per column (``fillna`` with a dict)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()})


def cond_means(df: DataFrame, measure: str, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: mean of ``measure`` over the rows meeting each condition."""
    m = F.col(measure).cast("double")
    return df.agg(*[F.avg(F.when(cond, m)).alias(name) for name, cond in conditions.items()])

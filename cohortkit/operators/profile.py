"""Profiling tables: overview, missingness, moments, quantiles, outliers,
box-plot numbers, histograms, density curves, frequency and rate tables.

Each function returns a small, chart-ready DataFrame computed with grouped
aggregations (partial aggregation before every shuffle).  Several columns are
profiled in one pass by unpivoting them to ``(column, value)`` first.

Functions that need a statistic before they can count (ranges, fences, caps) write
the profiled columns once, compute the statistic, a row for each column and
class, and hand it to the counting pass as a scalar subquery: rows are looked up in
that map, never joined.  ``by`` is therefore a class column, such as a label, and not a
key with a value for every few rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from cohortkit.operators.impute import attach_row
from cohortkit.operators.order_stats import looked_up, lookup_of, quantiles_by
from cohortkit.runtime import cut_lineage

__all__ = [
    "numeric_columns", "overview", "missing_report", "missing_pattern", "moments", "quantiles", "iqr_outliers",
    "box_summary", "histogram", "clipped_histogram", "kde", "value_counts", "group_rates", "melt",
]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns in schema order; booleans are not numeric."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType) and f.name not in set(exclude)]


def melt(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), value_type: str = "double") -> DataFrame:
    """``(keep..., column, value)`` long form of ``cols``."""
    base = df.select(*keep, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return base.unpivot(list(keep), list(cols), "column", "value")


def overview(df: DataFrame, label: str) -> DataFrame:
    """Row count, column count, label balance, and how many columns there are of
    each type, as ``type:count`` in the types' order."""
    types = [f.dataType.simpleString() for f in df.schema.fields]
    y = F.col(label).cast("int")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(y).cast("long").alias("label_true"),
        F.sum(1 - y).cast("long").alias("label_false"),
    ).select(
        "rows", "label_true", "label_false",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(len(df.columns) - 2).alias("features"),
        F.lit(",".join(f"{t}:{types.count(t)}" for t in sorted(set(types)))).alias("types"),
    )


def missing_report(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """``(column, missing, percent, dtype)`` sorted by missing desc (then name);
    one aggregation pass for all columns."""
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot(["__n"], df.columns, "column", "missing")
    dtypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    dt = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(dtypes[c]))])
    out = long.select(
        "column", F.col("missing").cast("long").alias("missing"),
        (F.col("missing") / F.col("__n") * 100.0).alias("percent"),
        dt[F.col("column")].alias("dtype"),
    )
    if only_missing:
        out = out.where(F.col("missing") > 0)
    return out.orderBy(F.col("missing").desc(), "column")


def missing_pattern(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Frequency of each null pattern over ``cols`` (pattern = '0'/'1' per
    column, 1 = missing); at most 2^k groups, partial-aggregated."""
    pattern = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in cols])
    return df.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("rows"))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected sample skewness and excess kurtosis per column (pandas
    ``skew``/``kurt``), from the population moments Spark returns."""
    long = melt(df, cols).where(F.col("value").isNotNull())
    g = long.groupBy("column").agg(
        F.count("value").alias("n"), F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2"))
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, ((n + 1) * F.col("g2") + 6) * (n - 1) / ((n - 2) * (n - 3)))
    return g.select("column", "n", skew.alias("skew"), kurt.alias("kurtosis"))


def _written(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The profiled columns, written once for the passes over them."""
    return cut_lineage(df.select(*dict.fromkeys([*keep, *cols])), "profiled")


def _known(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form without nulls and NaN."""
    return melt(df, cols, keep=keep).where(F.col("value").isNotNull() & ~F.isnan("value"))


def quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact linear-interpolated quantiles: ``(column, q<..>...)``."""
    got = quantiles_by(melt(df, cols), ["column"], qs, rounds=2)
    return got.select("column", *[F.col("q")[i].alias(_qname(q)) for i, q in enumerate(qs)])


def _qname(q: float) -> str:
    return f"q{int(round(q * 100))}"


def _fences(long: DataFrame, keys: Sequence[str], k: float) -> DataFrame:
    """Quartiles and the fences ``k`` interquartile ranges beyond them."""
    q = quantiles_by(long, keys, (0.25, 0.5, 0.75), rounds=2)
    q = q.select(*keys, *[F.col("q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))])
    return q.withColumns({"lower": F.col("q1") - k * (F.col("q3") - F.col("q1")), "upper": F.col("q3") + k * (F.col("q3") - F.col("q1"))})


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """IQR fences (Q1 - k*IQR, Q3 + k*IQR), strict outliers, share of non-null."""
    long = _known(_written(df, cols), cols)
    fences = lookup_of(_fences(long, ["column"], k), ["column"], ["lower", "upper"])
    at = long.withColumn("f", looked_up(fences, ["column"])).select("column", "value", "f.lower", "f.upper")
    out = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return at.groupBy("column", "lower", "upper").agg(
        F.count_if(out).alias("outliers"), (F.count_if(out) / F.count(F.lit(1)) * 100.0).alias("percent"))


def box_summary(df: DataFrame, cols: Sequence[str], by: str, k: float = 1.5) -> DataFrame:
    """Box-plot numbers per (column, class): quartiles, whiskers (extreme
    values inside the fences) and number of points outside."""
    keys, names = ["column", by], ["q1", "median", "q3", "lower", "upper"]
    long = _known(_written(df, cols, [by]), cols, keep=[by])
    fences = lookup_of(_fences(long, keys, k), keys, names)
    at = long.withColumn("f", looked_up(fences, keys)).select(*keys, "value", *[f"f.{c}" for c in names])
    inside = (F.col("value") >= F.col("lower")) & (F.col("value") <= F.col("upper"))
    return at.groupBy("column", by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("fliers"))


def _binned(long: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """Equal-width density histogram of a written long form over each key's own
    range: one pass for the ranges, one that counts (key, bin) in the tasks."""
    r = long.groupBy(*keys).agg(F.min("value").alias("mn"), F.max("value").alias("mx"), F.count(F.lit(1)).alias("total"))
    lo = F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn"))
    hi = F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx"))
    ranges = lookup_of(r.select(*keys, lo.alias("lo"), hi.alias("hi"), "total"), keys, ["lo", "hi", "total"])
    at = long.withColumn("r", looked_up(ranges, keys)).select(*keys, "value", "r.lo", "r.hi", "r.total")
    idx = F.floor((F.col("value") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo"))))
    idx = F.least(F.greatest(idx, F.lit(0)), F.lit(bins - 1))
    width = (F.col("hi") - F.col("lo")) / bins
    h = at.groupBy(*keys, idx.alias("bin"), "lo", "hi", "total").agg(F.count(F.lit(1)).alias("n"))
    return h.select(*keys, "bin", (F.col("lo") + F.col("bin") * width).alias("left"), "n", (F.col("n") / (F.col("total") * width)).alias("density"))


def histogram(df: DataFrame, cols: Sequence[str], by: str | None, bins: int = 40) -> DataFrame:
    """Equal-width density histogram per (column, class) over the class's own
    min..max; the last bin is closed.  A degenerate range is widened by 0.5
    each side.  ``density = n / (N * width)`` so the bars integrate to 1."""
    keep = [by] if by else []
    return _binned(_known(_written(df, cols, keep), cols, keep=keep), ["column", *keep], bins)


def clipped_histogram(df: DataFrame, cols: Sequence[str], by: str, bins: int = 50, clip_q: float = 0.95) -> DataFrame:
    """Histogram after dropping, per (column, class), values >= the class's
    ``clip_q`` quantile (the long tail)."""
    keys = ["column", by]
    long = _known(_written(df, cols, [by]), cols, keep=[by])
    caps = quantiles_by(long, keys, [clip_q], rounds=2).select(*keys, F.col("q")[0].alias("cap"))
    return _binned(long.where(F.col("value") < looked_up(lookup_of(caps, keys, ["cap"]), keys)["cap"]), keys, bins)


def kde(df: DataFrame, col: str, by: str, grid: int = 64, bins: int = 4096) -> DataFrame:
    """Gaussian kernel density per class on ``grid`` equally spaced points
    between the class min and max, Scott bandwidth ``std * n^(-1/5)``.

    Linear binning: a value between two of ``bins + 1`` equally spaced nodes gives
    each the share of the other's distance; then the kernel is summed over nodes
    instead of rows, so the cost is rows + bins * grid.  A value's kernel is thereby
    replaced by its chord between nodes ``d`` apart, which is off by at most
    ``d^2 / (8 h^2)`` of the kernel's peak.  A class of one value (no bandwidth) has
    null densities.
    """
    x = _written(df.select(F.col(by), F.col(col).cast("double").alias("x")).where(F.col(col).isNotNull()), ["x"], [by])
    s = x.groupBy(by).agg(F.min("x").alias("mn"), F.max("x").alias("mx"), F.count(F.lit(1)).alias("n"),
                          F.stddev_samp("x").alias("sd"))
    s = s.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    at = x.withColumn("s", looked_up(lookup_of(s, [by], ["mn", "mx", "n", "h"]), [by])).select(by, "x", "s.mn", "s.mx", "s.n", "s.h")
    step = (F.col("mx") - F.col("mn")) / bins
    u = F.when(step > 0, (F.col("x") - F.col("mn")) / step).otherwise(0.0)
    node = F.least(F.floor(u), F.lit(bins - 1))
    nodes = at.groupBy(by, node.alias("node"), "mn", "mx", "n", "h").agg(F.count(F.lit(1)).alias("near"), F.sum(u - node).alias("far"))
    j = nodes.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    pt = F.col("mn") + (F.col("mx") - F.col("mn")) * F.col("g") / F.lit(grid - 1)

    def kernel(k):
        z = F.when(F.col("h") > 0, (pt - (F.col("mn") + k * step)) / F.col("h"))
        return F.exp(-0.5 * z * z)

    each = (F.col("near") - F.col("far")) * kernel(F.col("node")) + F.col("far") * kernel(F.col("node") + 1)
    agg = j.groupBy(by, "g", "mn", "mx", "n", "h").agg(F.sum(each).alias("k"))
    return agg.select(
        by, F.col("g").alias("point"), (F.col("mn") + (F.col("mx") - F.col("mn")) * F.col("g") / F.lit(grid - 1)).alias("x"),
        (F.col("k") / (F.col("n") * F.when(F.col("h") > 0, F.col("h")) * F.lit(math.sqrt(2 * math.pi)))).alias("density"))


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Frequency of each non-null value (share of non-null rows when
    ``normalize``), most frequent first."""
    c = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = c.agg(F.sum("count").alias("__total"))
        c = attach_row(c, total).withColumn("share", F.col("count") / F.col("__total")).drop("__total")
    return c.orderBy(F.col("count").desc(), col)


def group_rates(df: DataFrame, keys: str | Sequence[str], measure: str) -> DataFrame:
    """Mean of ``measure`` (e.g. the 0/1 label) and row count per group."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.avg(F.col(measure).cast("double")).alias("mean"), F.count(F.lit(1)).alias("count"))

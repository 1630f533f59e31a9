"""Association statistics: contingency tables, chi-square tests, Pearson
correlations with a label and between columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.columns import strength_label

__all__ = ["crosstab", "chi_square", "chi2_sf", "corr_with", "corr_matrix"]


def crosstab(df: DataFrame, row: str, col: str, normalize: bool = False, missing: str | None = "Missing") -> DataFrame:
    """Long contingency table ``(row, col, n[, share])``.  Null row/col values
    become ``missing`` (or are dropped when ``missing`` is None).  ``share`` is
    the row-normalised frequency."""
    r, c = F.col(row).cast("string"), F.col(col).cast("string")
    if missing is None:
        base = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
        r2, c2 = r, c
    else:
        base = df
        r2, c2 = F.coalesce(r, F.lit(missing)), F.coalesce(c, F.lit(missing))
    t = base.groupBy(r2.alias("row"), c2.alias("col")).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        # the table has (#row values x #col values) cells; a per-row window on it is small
        t = t.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("row")))
    return t


def chi2_sf(x: float, k: int) -> float:
    """Upper tail of the chi-square distribution, Q(k/2, x/2) (regularised
    upper incomplete gamma; series below a+1, continued fraction above)."""
    if x is None or k is None or k <= 0 or x != x:
        return float("nan")
    if x <= 0:
        return 1.0
    a, z = k / 2.0, x / 2.0
    lg = math.lgamma(a)
    if z < a + 1:
        term = 1.0 / a
        total = term
        n = a
        for _ in range(10000):
            n += 1
            term *= z / n
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        return max(0.0, 1.0 - total * math.exp(-z + a * math.log(z) - lg))
    tiny = 1e-300
    b = z + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-16:
            break
    return math.exp(-z + a * math.log(z) - lg) * h


def _chi2_sf_batch(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(float(a), int(b)) if pd.notna(a) and pd.notna(b) else float("nan") for a, b in zip(x, k)])


def _chi2_sf_udf(x, k):
    """Vectorised (Arrow batch) p-value on the small per-column result."""
    return F.pandas_udf(_chi2_sf_batch, "double")(x, k)


def chi_square(df: DataFrame, cols: Sequence[str], label: str, missing: str = "Missing", with_p: bool = True) -> DataFrame:
    """Chi-square test of independence of each column against ``label``.

    Contingency counts for all columns come from one aggregation over the
    unpivoted ``(column, value, label)``; expected counts use row and column
    totals, grouped sums of the count table.  With one degree of
    freedom the Yates continuity correction is applied (as scipy does).
    Output: ``(column, chi2, dof[, p, strength])``.
    """
    base = df.select(F.col(label).cast("string").alias("__y"), *[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in cols])
    long = base.unpivot(["__y"], list(cols), "column", "value")
    t = long.groupBy("column", "value", "__y").agg(F.count(F.lit(1)).cast("double").alias("o"))
    # row and column totals joined on the column make the whole grid: cells with zero count still contribute an expected value
    rows = t.groupBy("column", "value").agg(F.sum("o").alias("rt"))
    cols_ = t.groupBy("column", "__y").agg(F.sum("o").alias("ct"))
    totals = rows.groupBy("column").agg(F.sum("rt").alias("tot"), F.count(F.lit(1)).alias("nr"))
    widths = cols_.groupBy("column").agg(F.count(F.lit(1)).alias("nc"))
    grid = rows.join(cols_, "column").join(totals, "column").join(widths, "column")
    t = grid.join(t, ["column", "value", "__y"], "left").fillna(0.0, subset=["o"])
    t = t.withColumn("e", F.col("rt") * F.col("ct") / F.col("tot")).withColumn("dof", (F.col("nr") - 1) * (F.col("nc") - 1))
    diff = F.abs(F.col("o") - F.col("e"))
    corr = F.when(F.col("dof") == 1, F.least(F.lit(0.5), diff)).otherwise(F.lit(0.0))
    t = t.withColumn("cell", F.pow(diff - corr, 2) / F.col("e"))
    out = t.groupBy("column").agg(F.sum("cell").alias("chi2"), F.first("dof").cast("long").alias("dof"))
    if with_p:
        out = out.withColumn("p", _chi2_sf_udf(F.col("chi2"), F.col("dof")))
        out = out.withColumn("strength", strength_label("p"))
    return out


def corr_with(df: DataFrame, cols: Sequence[str], label: str, top: int | None = None) -> DataFrame:
    """Pearson correlation of each column with ``label`` (pairwise complete),
    sorted by absolute value; one aggregation for all columns."""
    y = F.col(label).cast("double")
    one = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(c) for c in cols])
    long = one.unpivot([], list(cols), "column", "r")
    long = long.orderBy(F.abs(F.col("r")).desc_nulls_last(), "column")
    return long.limit(top) if top else long


def corr_matrix(df: DataFrame, cols: Sequence[str], lower: bool = True) -> DataFrame:
    """Pairwise Pearson correlations ``(a, b, r)`` (pairwise complete), one
    aggregation for all pairs; lower triangle incl. diagonal by default."""
    pairs = [(a, b) for i, a in enumerate(cols) for j, b in enumerate(cols) if (j <= i if lower else True)]
    names = [f"__r{i}" for i in range(len(pairs))]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(n) for (a, b), n in zip(pairs, names)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(n).alias("r")) for (a, b), n in zip(pairs, names)])
    return one.select(F.inline(rows))

"""Group-aware imputation.

A *level* fills the nulls of some columns from a statistic of the same column
computed over groups of ``keys``:

* mode   - most frequent non-null value, the smallest one on ties; and
* median - exact, linearly interpolated median of the non-null values.

Both come from counts by value (``order_stats``): no key's values are held by one
reducer, whatever their number.

A NULL key is a group of its own (rows with an unknown key still share a
statistic), which is why statistics are joined back with null-safe equality.

Levels run *sequentially*: level k+1 computes its statistics on data already
filled by level k.  A cascade counts the keys of a level first: statistics of few
keys are written and broadcast, so that rows stay where they are; many keys with few rows each are filled where the shuffle by key
puts their rows together; for other keys the statistics are joined to the open rows (those
that miss one of the level's columns), and AQE splits skewed partitions.

Rows are written to the shared checkpoint folder at the start and after
levels that shuffle them, so plans stay short and a lost executor does not replay every level.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.columns import lookup
from cohortkit.operators.order_stats import stats_by
from cohortkit.runtime import cut_lineage

__all__ = [
    "Level", "attach_row", "mode_stats", "median_stats", "group_stats", "fill_from_stats", "fill_mode", "fill_median",
    "fill_global_median", "cascade", "fill_from_lookup", "update_where", "infer_flag", "repair_flag",
]

#: Rows of a key that one task may hold at once, and keys whose statistics, a row each, may be broadcast.
FEW_ROWS = 10_000
FEW_KEYS = 10_000


@dataclass
class Level:
    """One imputation level: statistics by ``keys`` for several columns."""

    keys: Sequence[str]
    modes: Sequence[str] = field(default_factory=list)
    medians: Sequence[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return [*self.modes, *self.medians]


Step = Level | Sequence[Level] | Callable[[DataFrame], DataFrame]


def _stat_name(c: str) -> str:
    return f"__stat_{c}"


def group_stats(df: DataFrame, keys: Sequence[str], modes: Sequence[str] = (), medians: Sequence[str] = (),
                approx_medians: bool = False, accuracy: int = 10_000, rounds: int = 1, few: bool = False) -> DataFrame:
    """``(keys..., __stat_<column>...)``: every requested statistic of every key.

    ``approx_medians=True`` (opt-in) uses ``percentile_approx``: one pass with a
    fixed-size sketch per key.  It returns an observed value (no interpolation),
    so results differ from the exact median.  ``rounds`` and ``few`` as in
    ``order_stats``: they change the plan, not the result.
    """
    named = {f"__k{i}": k for i, k in enumerate(keys)}
    if medians and approx_medians:
        aggs = [F.mode(F.col(c), True).alias(_stat_name(c)) for c in modes]
        aggs += [F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(_stat_name(c)) for c in medians]
        return df.groupBy(*keys).agg(*aggs)
    stats = stats_by(df, keys, modes, medians, rounds, few)
    return stats.withColumnsRenamed({c: _stat_name(c) for c in [*modes, *medians]}).withColumnsRenamed(named)


def mode_stats(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """Per-key mode table ``(keys..., mode)``; keys without a value have no row."""
    return group_stats(df, keys, modes=[col]).withColumnRenamed(_stat_name(col), "mode")


def median_stats(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """Per-key median table ``(keys..., median)``; keys without a value have no row."""
    return group_stats(df, keys, medians=[col]).withColumnRenamed(_stat_name(col), "median")


def fill_from_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``coalesce(c, stat_c)`` after a null-safe left join on ``keys``.

    With no keys the statistics are one row (global level) and are attached by
    a one-row broadcast join, which is size-bounded by construction.
    """
    if not keys:
        joined = attach_row(df, stats)
    else:
        s = stats.select(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], *[_stat_name(c) for c in cols])
        cond = [df[k].eqNullSafe(s[f"__key_{i}"]) for i, k in enumerate(keys)]
        joined = df.join(s, on=cond, how="left")
    out = [F.coalesce(F.col(c), F.col(_stat_name(c)).cast(df.schema[c].dataType)).alias(c) if c in cols else F.col(c)
           for c in df.columns]
    return joined.select(*out)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table (global statistics) to every
    row: broadcast hash join on a constant key, size-bounded by construction."""
    return df.withColumn("__one", F.lit(1)).join(F.broadcast(one_row.withColumn("__one", F.lit(1))), "__one").drop("__one")


def fill_mode(df: DataFrame, cols: str | Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Fill nulls of ``cols`` with the per-group mode (one level)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    stats = group_stats(df, keys, modes=cols)
    return fill_from_stats(df, stats, keys, cols)


def fill_global_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    stats = group_stats(df, [], medians=cols)
    return fill_from_stats(df, stats, [], cols)


def fill_median(df: DataFrame, cols: str | Sequence[str], levels: Sequence[Sequence[str]], global_fill: bool = True,
                cut_every: int = 1, approx_medians: bool = False, narrow: bool = True) -> DataFrame:
    """Sequential group medians over ``levels`` then (optionally) the global
    median."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    plan = [Level(keys=list(k), medians=cols) for k in levels]
    if global_fill:
        plan.append(Level(keys=[], medians=cols))
    return cascade(df, plan, cut_every=cut_every, approx_medians=approx_medians, narrow=narrow)


def _any_null(cols: Sequence[str]) -> Column:
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull()
    return missing


def _key_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Number of keys and rows of the largest one: one count by key."""
    if not keys:
        return 1, FEW_ROWS + 1
    r = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.max("__n"), F.lit(0)).alias("most")).first()
    return r["keys"], r["most"]


def _fill_in_place(df: DataFrame, lv: Level) -> DataFrame:
    """A level whose keys have few rows each: the rows are put together by key
    once, and every row takes the statistics of its own group there."""
    w = Window.partitionBy(*lv.keys)
    stats = {c: F.mode(F.col(c), True).over(w) for c in lv.modes}
    values = {c: F.col(c).cast("double") for c in lv.medians}
    stats |= {c: F.median(F.when(~F.isnan(v), v)).over(w) for c, v in values.items()}
    return df.select(*[F.coalesce(F.col(c), stats[c].cast(df.schema[c].dataType)).alias(c) if c in stats else F.col(c) for c in df.columns])


def _fill_open(df: DataFrame, stats: DataFrame, lv: Level) -> DataFrame:
    """Joins the statistics to the rows that miss a column of the level."""
    missing = _any_null(lv.columns)
    return fill_from_stats(df.where(missing), stats, lv.keys, lv.columns).unionByName(df.where(~missing))


def cascade(df: DataFrame, steps: Sequence[Step], cut_every: int = 0, approx_medians: bool = False, narrow: bool = False) -> DataFrame:
    """Run ``steps`` in order; each sees the values filled by the previous
    ones.  A step is a level; or several levels of different columns, none of
    which is a key of another, which then run at once; or a change of rows, a
    function of a DataFrame that looks at one row at a time.

    ``cut_every > 0`` writes the table first, and counts the keys of each level and the rows of
    the largest one.  Few keys: their statistics are written, a row for each key, and
    broadcast to the rows, which aren't shuffled.  Many keys of few rows each: the rows are shuffled by key and
    filled within their groups; ``narrow`` forbids it.  Otherwise statistics and open rows are joined.  Rows are
    written again after every step that shuffled or changed them, and what they were written from is deleted.  All give the same result."""
    plan = [s if callable(s) else [s] if isinstance(s, Level) else list(s) for s in steps]
    if cut_every:
        last = df = cut_lineage(df, "cascade")
    for step in plan:
        if callable(step):
            df = step(df)
            if cut_every:
                last = df = cut_lineage(df, "changed", instead=last)
            continue
        cols = [c for lv in step for c in lv.columns]
        if len(set(cols)) < len(cols):
            raise ValueError(f"levels of one step must fill different columns: {cols}")
        shuffled = False
        for lv in step:
            if not cut_every:
                df = _fill_open(df, group_stats(df, lv.keys, lv.modes, lv.medians, approx_medians), lv)
                continue
            keys, most = _key_sizes(df, lv.keys)
            few = keys <= FEW_KEYS
            if most <= FEW_ROWS and not few and not narrow and not approx_medians:
                df, shuffled = _fill_in_place(df, lv), True
                continue
            stats = group_stats(df, lv.keys, lv.modes, lv.medians, approx_medians, few=few)
            if few:
                df = fill_from_stats(df, F.broadcast(cut_lineage(stats, "stats")), lv.keys, lv.columns)
            else:
                df, shuffled = _fill_open(df, stats, lv), True
        if shuffled:
            last = df = cut_lineage(df, "open", instead=last)
    return df


def fill_from_lookup(df: DataFrame, col: str, key: str, mapping: Mapping) -> DataFrame:
    """Fill nulls of ``col`` from a literal dictionary applied to ``key``."""
    return df.withColumn(col, F.coalesce(F.col(col), lookup(key, mapping)))


def update_where(df: DataFrame, col: str, predicate: Column, value) -> DataFrame:
    """``UPDATE df SET col = value WHERE predicate`` (null predicate = no-op)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(F.coalesce(predicate, F.lit(False)), v).otherwise(F.col(col)))


def infer_flag(df: DataFrame, flag: str, activity_cols: Sequence[str], total_col: str | None = None) -> DataFrame:
    """Flag inferred from activity for rows where it is unknown: any activity
    (> 0) -> False; no recorded activity (sum of known values == 0) -> True."""
    from cohortkit.functions.columns import row_sum

    total = F.col(total_col) if total_col else row_sum(activity_cols, min_count=1)
    df = update_where(df, flag, (F.coalesce(total, F.lit(0.0)) > 0) & F.col(flag).isNull(), False)
    return update_where(df, flag, (row_sum(activity_cols) == 0) & F.col(flag).isNull(), True)


def repair_flag(df: DataFrame, flag: str, total_col: str) -> DataFrame:
    """A flag that contradicts recorded activity is switched off."""
    return update_where(df, flag, (F.col(total_col) > 0) & (F.col(flag) == F.lit(True)), False)

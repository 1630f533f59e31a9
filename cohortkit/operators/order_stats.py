"""Exact order statistics by key: modes, medians and quantiles of several
columns at once, with no key's values in one reducer's memory.

The rows are put in long form ``(keys, column, value)``, and the wanted ranks are
searched in counts:

1. values fall into *cells*, a function of the value alone that never
   decreases (a signed logarithm, at most ``2 * 715 000`` cells, a few
   thousand for usual data); the cells of a key are counted, in the tasks before the
   shuffle, and their running sum tells which cells hold the wanted ranks;
2. only the rows of those cells go on.  ``rounds - 1`` more times, each held
   cell is split into ``SPLIT`` equal steps between its own least and greatest value;
3. the rows of the last cells are counted by value, put in order cell by
   cell, and the values at the wanted ranks are read off.

So the state of a task is bounded by the number of cells, and what is
sorted together is the distinct values of one narrow cell.  A key with many rows
shuffles its cells, not its rows.

Nulls and NaN are no values; a key without values has no row; NULL keys are
a group of their own.  Infinite values are ranked as such.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["SPLIT", "cell", "quantiles_by", "ranked_by", "stats_by", "lookup_of", "looked_up"]

#: Steps into which a narrowing round splits a cell.
SPLIT = 4096


def cell(value: Column) -> Column:
    """Cell number of a double: never decreases with the value, steps of 0.1 %
    of the value above 1e-6 in size."""
    size = F.floor(F.log1p(F.least(F.abs(value), F.lit(1e300)) * 1e6) * 1000.0)
    return F.when(value < 0, -size - 1).otherwise(size)


def _step(value: Column, low: Column, high: Column) -> Column:
    """Which of ``SPLIT`` equal steps between low and high: never decreases."""
    wide = F.when(F.abs(low) + F.abs(high) < F.lit(float("inf")), high - low)
    part = F.floor(F.when(wide > 0, (value - low) / wide * SPLIT).otherwise(0.0))
    return F.coalesce(F.least(part, F.lit(SPLIT - 1)), F.when(value == low, 0).when(value == high, SPLIT + 1).otherwise(SPLIT).cast("long"))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [left[k].eqNullSafe(right[f"__w_{k}"]) for k in keys]


def _place(p: float) -> Column:
    return F.lit(float(p)) * (F.col("__total") - 1)


def _between(p: float, low: Column, high: Column) -> Column:
    """Linear interpolation between the values at the two ranks of a quantile."""
    place = _place(p)
    return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)


def quantiles_by(long: DataFrame, keys: Sequence[str], probs: Sequence[float], rounds: int = 1) -> DataFrame:
    """``(keys, n, q)``: the number of values of ``long`` (keys, value double)
    and their linearly interpolated quantiles, one for each of ``probs``."""
    ranked = ranked_by(long, keys, probs, rounds)
    aggs = []
    for i, p in enumerate(probs):
        for side, rank in (("a", F.floor(_place(p))), ("b", F.ceil(_place(p)))):
            aggs.append(F.max(F.when((F.col("__start") <= rank) & (rank < F.col("__end")), F.col("value"))).alias(f"__{side}{i}"))
    found = ranked.groupBy(*[F.col(k) for k in keys], "__total").agg(*aggs)
    out = [_between(p, F.col(f"__a{i}"), F.col(f"__b{i}")) for i, p in enumerate(probs)]
    return found.select(*keys, F.col("__total").alias("n"), F.array(*out).alias("q"))


def ranked_by(long: DataFrame, keys: Sequence[str], probs: Sequence[float], rounds: int = 1, few: bool = False) -> DataFrame:
    """``(keys, value, n, __start, __end, __total)``: values around the ranks of
    ``probs`` with the ranks ``__start .. __end - 1`` they hold among ``__total``.
    ``few``: the caller counted few keys; their held cells, a row or two for each
    key and rank, are broadcast, and no row is shuffled to find them."""
    keys = list(keys)
    path = [*keys]
    part = long.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("__cell", cell(F.col("value")))
    spot = F.array(*[F.lit(float(p)) for p in probs])
    for i in range(rounds):
        cells = part.groupBy(*path, *(["__before", "__total"] if i else []), "__cell").agg(
            F.count(F.lit(1)).alias("__n"), F.min("value").alias("__low"), F.max("value").alias("__high"))
        order = Window.partitionBy(*[F.col(c) for c in path]).orderBy("__cell")
        up_to = F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__n")
        if i:
            placed = cells.withColumn("__at", F.col("__before") + up_to)
        else:
            whole = F.sum("__n").over(Window.partitionBy(*[F.col(c) for c in path]))
            placed = cells.withColumns({"__at": up_to, "__total": whole})
        # the places of a quantile are the two ranks around p * (total - 1)
        wanted = F.exists(spot, lambda p: (F.ceil(p * (F.col("__total") - 1)) >= F.col("__at")) & (F.floor(p * (F.col("__total") - 1)) < F.col("__at") + F.col("__n")))
        held = placed.where(wanted)
        names = [*path, "__cell"]
        held = held.select(*[F.col(c).alias(f"__w_{c}") for c in names], F.col("__at").alias("__before"), "__total", "__low", "__high")
        rest = part.drop("__before", "__total", "__low", "__high") if i else part
        part = rest.join(F.broadcast(held) if few else held, _same(rest, held, names), "inner").drop(*[f"__w_{c}" for c in names])
        if i + 1 < rounds:
            part = part.withColumn(f"__c{i}", F.col("__cell")).withColumn("__cell", _step(F.col("value"), F.col("__low"), F.col("__high")))
            path = [*path, f"__c{i}"]
    part = part.groupBy(*path, "__cell", "__before", "__total", "value").agg(F.count(F.lit(1)).alias("n"))
    by_cell = Window.partitionBy(*[F.col(c) for c in path], "__cell").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = part.withColumn("__end", F.col("__before") + F.sum("n").over(by_cell)).withColumn("__start", F.col("__end") - F.col("n"))
    return ranked.select(*keys, "value", "n", "__start", "__end", "__total")


def _long(df: DataFrame, keys: Sequence[str], cols: Sequence[str], kind: str) -> DataFrame:
    """``(__k0.., column, value)`` of ``cols``, by their place; the keys renamed, as
    a column may be a key and a value at once."""
    named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast(kind).alias("value")) for i, c in enumerate(cols)]))
    return df.select(*named, each.alias("__v")).select(*[f"__k{i}" for i in range(len(keys))], "__v.column", "__v.value")


def stats_by(df: DataFrame, keys: Sequence[str], modes: Sequence[str], medians: Sequence[str], rounds: int = 1, few: bool = False) -> DataFrame:
    """``(__k0.., <column>..)``: the most frequent value of each column of
    ``modes`` (the least among equally frequent ones) and the exact median of each
    of ``medians``, a row for each key that has any of them.  Counts of values are
    reduced to a key's row by one aggregation with a few bytes of state a column.

    ``few`` as in ``ranked_by``.  ``rounds=0`` is the plan for a table whose measured size lets one task hold
    all its values: Spark's own exact aggregates, in one stage."""
    names = [f"__k{i}" for i in range(len(keys))]
    if rounds == 0:
        aggs = [F.mode(F.col(c), True).alias(c) for c in modes] + [F.median(F.col(c).cast("double")).alias(c) for c in medians]
        return df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(*aggs)
    rows = []
    if modes:
        long = _long(df, keys, modes, "string").where(F.col("value").isNotNull())
        counts = long.groupBy(*names, "column", "value").agg(F.count(F.lit(1)).alias("n"))
        rows.append(counts.select(*names, "column", "value", F.col("n"), *[F.lit(None).cast("double").alias(c) for c in ("low", "high")]))
    if medians:
        ranked = ranked_by(_long(df, keys, medians, "double"), [*names, "column"], [0.5], rounds, few)
        at = [F.when((F.col("__start") <= r) & (r < F.col("__end")), F.col("value")).alias(c) for c, r in (("low", F.floor(_place(0.5))), ("high", F.ceil(_place(0.5))))]
        rows.append(ranked.select(*names, (F.col("column") + len(modes)).alias("column"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("long").alias("n"), *at))
    both = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
    aggs = [F.min(F.when(F.col("column") == i, F.struct((-F.col("n")).alias("rank"), F.col("value").cast(df.schema[c].dataType).alias("value")))).alias(f"m{i}") for i, c in enumerate(modes)]
    aggs += [F.max(F.when(F.col("column") == i + len(modes), F.col(s))).alias(f"{s}{i}") for i in range(len(medians)) for s in ("low", "high")]
    found = both.groupBy(*names).agg(*aggs)
    return found.select(*names, *[F.col(f"m{i}.value").alias(c) for i, c in enumerate(modes)],
                        *[F.when(F.col(f"low{i}") == F.col(f"high{i}"), F.col(f"low{i}")).otherwise(0.5 * F.col(f"low{i}") + 0.5 * F.col(f"high{i}")).alias(c) for i, c in enumerate(medians)])


def lookup_of(stats: DataFrame, keys: Sequence[str], values: Sequence[str]) -> Column:
    """A small table of statistics as one map, read as a scalar subquery:
    ``lookup[key]`` gives the struct of ``values`` without a join.  For tables
    with a row for each profiled column and class, not for keys of rows."""
    whole = stats.agg(F.map_from_entries(F.collect_list(F.struct(_key(keys), F.struct(*values)))).alias("m"))
    return whole.scalar()


def _key(keys: Sequence[str]) -> Column:
    return F.concat_ws("\x00", *[F.coalesce(F.col(k).cast("string"), F.lit("\x01")) for k in keys])


def looked_up(lookup: Column, keys: Sequence[str]) -> Column:
    """The entry of the row's own keys."""
    return lookup[_key(keys)]

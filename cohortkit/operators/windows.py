"""Skew-safe ordered windows.

``Window.partitionBy(k).orderBy(o)`` evaluates each key in one task, so a
key that holds a third of the table becomes one task holding a third of the
table.  ``prefix_sums`` first measures group sizes (one partial-aggregated
count) and splits the keys:

* ordinary keys (at most ``hot_rows`` rows) use the plain window - each
  group fits one task;
* without keys, the whole table takes the range path below, at any size;
* hot keys (a bounded number: at most ``rows / hot_rows`` of them, so their
  list is broadcast) take the range path:

  1. range-partition their rows on ``(keys, order)`` so one hot key is spread
     over many contiguous partitions, materialised once in the shared
     checkpoint folder so every later use sees the same partitions;
  2. running sums within each (partition, key);
  3. per (partition, key) totals -> offsets by an ordered window over
     partitions (a hot key spans at most #partitions rows there);
  4. offset + local running sum.

``order`` must be a total order (add a unique tie-breaker) for reproducible
results on ties.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.runtime import cut_lineage

__all__ = ["prefix_sums", "row_ranks", "sample_n", "HOT_ROWS"]

# Rows a single task may sort for one key before the key is treated as hot.
HOT_ROWS = 5_000_000


def _ordered(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _window_path(src: DataFrame, keys, order_cols, outs) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return src.withColumns({f"__r_{o}": F.sum(f"__v_{o}").over(w) for o in outs})


def _range_path(src: DataFrame, keys, order_cols, outs, partitions: int) -> DataFrame:
    t = src.repartitionByRange(partitions, *[F.col(k) for k in keys], *order_cols).withColumn("__pid", F.spark_partition_id())
    t = cut_lineage(t, "ranged")
    w_local = Window.partitionBy("__pid", *keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumns({f"__l_{o}": F.sum(f"__v_{o}").over(w_local) for o in outs})
    totals = t.groupBy("__pid", *keys).agg(*[F.sum(f"__v_{o}").alias(f"__t_{o}") for o in outs])
    w_off = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__pid").alias("__opid"), *[F.col(k).alias(f"__ok_{i}") for i, k in enumerate(keys)],
                            *[F.coalesce(F.sum(f"__t_{o}").over(w_off), F.lit(0)).alias(f"__o_{o}") for o in outs])
    cond = [F.col("__pid") == F.col("__opid")] + [F.col(k).eqNullSafe(F.col(f"__ok_{i}")) for i, k in enumerate(keys)]
    j = t.join(offsets, cond, "left")
    j = j.withColumns({f"__r_{o}": F.col(f"__o_{o}") + F.col(f"__l_{o}") for o in outs})
    return j.drop("__pid", "__opid", *[f"__ok_{i}" for i in range(len(keys))], *[f"__{p}_{o}" for o in outs for p in ("l", "o")])


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], sums: Mapping[str, str | Column],
                inclusive: bool = True, hot_rows: int | None = None, partitions: int | None = None) -> DataFrame:
    """Add running sums ``{out: value}`` within ``keys`` ordered by ``order``
    (including the current row unless ``inclusive=False``)."""
    spark = df.sparkSession
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    outs = list(sums)
    src = df.withColumns({f"__v_{o}": (F.col(v) if isinstance(v, str) else v) for o, v in sums.items()})
    order_cols = _ordered(order)
    keys = list(keys)
    if keys:
        sizes = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
        hot = sizes.where(F.col("__size") > hot_rows).select(*[F.col(k).alias(f"__hk_{i}") for i, k in enumerate(keys)],
                                                              F.lit(True).alias("__hot"))
        n_hot = hot.count()
    if not keys:  # one key for the whole table: never one task
        res = _range_path(src, keys, order_cols, outs, n_parts)
    elif n_hot == 0:
        res = _window_path(src, keys, order_cols, outs)
    else:
        # the hot-key list has at most rows/hot_rows entries: a bounded broadcast
        cond = [F.col(k).eqNullSafe(F.col(f"__hk_{i}")) for i, k in enumerate(keys)]
        marked = src.join(F.broadcast(hot), cond, "left").drop(*[f"__hk_{i}" for i in range(len(keys))])
        cold = marked.where(F.col("__hot").isNull()).drop("__hot")
        hotrows = marked.where(F.col("__hot")).drop("__hot")
        res = _window_path(cold, keys, order_cols, outs).unionByName(_range_path(hotrows, keys, order_cols, outs, n_parts))
    final = {o: (F.col(f"__r_{o}") if inclusive else F.col(f"__r_{o}") - F.col(f"__v_{o}")) for o in outs}
    return res.withColumns(final).drop(*[f"__r_{o}" for o in outs], *[f"__v_{o}" for o in outs])


def row_ranks(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "rank", hot_rows: int | None = None) -> DataFrame:
    """0-based position of each row within ``keys`` in ``order`` (a
    distributed ``row_number() - 1``)."""
    return prefix_sums(df, keys, order, {out: F.lit(1).cast("long")}, inclusive=False, hot_rows=hot_rows)


def sample_n(df: DataFrame, n: int, key: Column, tie: str | None = None) -> DataFrame:
    """Seeded fixed-size sample without replacement: the ``n`` rows with the
    smallest pseudo-random ``key``.  Each task keeps only its own ``n`` best
    rows before the merge, so memory is bounded by ``n`` per task."""
    order = [key] + ([F.col(tie)] if tie else [])
    return df.orderBy(*order).limit(n)

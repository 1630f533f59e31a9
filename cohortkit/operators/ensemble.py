"""Blending and decision thresholds on long score tables ``(id, model, y, p)``
or wide ones (``p_<model>`` columns).

Cut semantics: a cut ``c`` predicts positive when ``p > c``; ``-inf`` is "all
positive".  Rows with equal scores always fall on the same side (the score
table is first collapsed to one row per distinct score), so the accuracy
reported is the accuracy obtained when the cut is applied.  The best cut
maximises correct decisions; among equal ones the smallest cut wins, and
"all positive" is kept unless strictly beaten.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.columns import weighted_sum
from cohortkit.operators.impute import attach_row
from cohortkit.operators.windows import prefix_sums
from cohortkit.runtime import cut_lineage

__all__ = ["NEG_INF", "blend", "best_cut", "weight_grid", "tune_blend", "grid_errors", "stack_columns", "stack_faults", "group_cuts", "apply_cuts",
           "pick_calibration", "decisions"]

NEG_INF = float("-inf")


def blend(df: DataFrame, weights: Mapping[str, float | Column], out: str = "p_blend") -> DataFrame:
    """Linear combination of score columns (left to right)."""
    return df.withColumn(out, weighted_sum(weights))


def best_cut(scores: DataFrame, by: Sequence[str] = (), score: str = "p", label: str = "y", hot_rows: int | None = None) -> DataFrame:
    """Accuracy-optimal cut per group ``by``: ``(by..., cut, correct, n, accuracy)``.

    1. collapse to distinct scores: ``(by, p, n, pos)`` (partial aggregation);
    2. running sums of n and pos in score order (skew-safe ``prefix_sums``);
    3. correct(c) = negatives at or below c + positives above c;
    4. per group the best (max correct, then smallest c) against all-positive.
    """
    by = list(by)
    c = scores.groupBy(*by, F.col(score).alias("__p")).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(F.col(label).cast("long")).alias("__pos"))
    c = prefix_sums(c, by, ["__p"], {"__cn": "__n", "__cpos": "__pos"}, hot_rows=hot_rows)
    # the group's positives are the same for all its cuts, so they don't move the minimum
    best = c.groupBy(*by).agg(F.min(F.struct((2 * F.col("__cpos") - F.col("__cn")).alias("loss"), F.col("__p").alias("p"))).alias("b"),
                              F.sum("__n").alias("n"), F.sum("__pos").alias("ptot"))
    beaten = F.col("b.loss") < 0
    correct = F.col("ptot") - F.least(F.col("b.loss"), F.lit(0))
    return best.select(*by, F.when(beaten, F.col("b.p")).otherwise(F.lit(NEG_INF)).alias("cut"),
                       correct.cast("long").alias("correct"), F.col("n").cast("long").alias("n"),
                       (correct / F.col("n")).alias("accuracy"))


def weight_grid(df: DataFrame, steps: int = 100) -> DataFrame:
    """Attach every weight triple (i, j, steps-i-j)/steps with all three >= 1
    step to each row, generated per row (fixed fan-out, no join)."""
    i = F.explode(F.sequence(F.lit(1), F.lit(steps - 2))).alias("__wi")
    with_i = df.select("*", i)
    j = F.explode(F.sequence(F.lit(1), F.lit(steps - 1) - F.col("__wi"))).alias("__wj")
    return with_i.select("*", j)


def _grid_weights(wi: Column, wj: Column, steps: int):
    return (wi.cast("double") / steps, wj.cast("double") / steps, (F.lit(steps) - wi - wj).cast("double") / steps)


# Counters that a task keeps for all weights and bins of a pass (two longs each).
BLEND_CELLS = 1 << 21

# Weights few enough to be judged exactly, row by row.
BLEND_FINAL = 32


def _triples(steps: int) -> np.ndarray:
    """All (i, j) with i, j and steps - i - j of one step at least."""
    return np.array([(i, j) for i in range(1, steps - 1) for j in range(1, steps - i)], dtype=np.int64).reshape(-1, 2)


def _blend_bounds(rows: DataFrame, triples: np.ndarray, steps: int, low: float, high: float, bins: int, positives: int) -> tuple[np.ndarray, np.ndarray]:
    """For each weight triple what its best cut gets right at least and at most,
    from counts by score bin: cuts between bins are exact, and a cut inside a
    bin gains at most the bin's negatives.

    Each task bins its rows for all triples and hands on one block of counters
    for every 64th of the triples, so what is shuffled doesn't depend on the rows."""
    n, part = len(triples), max(1, -(-len(triples) // 64))
    weight = [(triples[:, 0] / steps)[:, None], (triples[:, 1] / steps)[:, None], ((steps - triples[:, 0] - triples[:, 1]) / steps)[:, None]]
    scale = bins / (high - low) if high > low else 0.0

    def count(batches):
        all_, pos = np.zeros(n * bins, np.int64), np.zeros(n * bins, np.int64)
        base = np.arange(n)[:, None] * bins
        step = max(1, (1 << 21) // n)
        for batch in batches:
            y, a, b, c = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            for at in range(0, len(y), step):
                own = slice(at, at + step)
                score = weight[0] * a[own] + weight[1] * b[own] + weight[2] * c[own]
                place = base + np.clip(np.floor((score - low) * scale), 0, bins - 1).astype(np.int64)
                all_ += np.bincount(place.ravel(), minlength=n * bins)
                pos += np.bincount(place[:, y[own] == 1].ravel(), minlength=n * bins)
        starts = range(0, n, part)
        yield pa.RecordBatch.from_arrays([pa.array(list(range(len(starts))), pa.int32()), *(pa.array([x[k * bins : min(k + part, n) * bins].tobytes() for k in starts], pa.binary()) for x in (all_, pos))], ["part", "n", "pos"])

    def add(batches):
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for k, x, z in zip(*(batch.column(c).to_pylist() for c in range(3))):
                own = [np.frombuffer(v, np.int64) for v in (x, z)]
                held[k] = [h + o for h, o in zip(held[k], own)] if k in held else own
        out: list[list] = [[], [], []]
        for k, (x, z) in held.items():
            x, z = x.reshape(-1, bins), z.reshape(-1, bins)
            gain = np.cumsum(x - 2 * z, axis=1)  # right beyond "all positive" for a cut after each bin
            before = np.hstack([np.zeros((len(gain), 1), np.int64), gain[:, :-1]])
            out[0] += range(k * part, k * part + len(x))
            out[1] += (positives + np.maximum(0, gain.max(axis=1))).tolist()
            out[2] += (positives + np.maximum(0, (before + x - z).max(axis=1))).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], ["triple", "least", "most"])

    blocks = rows.mapInArrow(count, "part int, n binary, pos binary").repartition("part")
    got = blocks.mapInArrow(add, "triple long, least long, most long").toArrow()  # a row for each triple
    least, most = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = got["triple"].to_numpy()
    least[at], most[at] = got["least"].to_numpy(), got["most"].to_numpy()
    return least, most


def tune_blend(wide: DataFrame, models: Sequence[str], label: str = "y", steps: int = 100, hot_rows: int | None = None) -> DataFrame:
    """Exhaustive best blend of three score columns on the ``1/steps`` grid
    (all three weights >= 1 step), judged by best-cut accuracy; ties keep the
    first triple in (w1, w2) order.  One row ``(w_<m>..., cut, correct, n, accuracy)``.

    The grid is narrowed by passes over the written scores: counts by score bin
    bound what each triple's best cut can get right, triples that can't reach the
    best lower bound are out, and the rest get finer bins (``BLEND_CELLS`` counters
    a task).  The triples left, ``BLEND_FINAL`` or as many as no finer bins tell
    apart, are judged by ``best_cut``.  A null score or label counts in no cut."""
    a, b, c = models
    base = wide.select(F.col(label).cast("int").alias("__y"), *[F.col(m).cast("double").alias(n) for m, n in ((a, "__a"), (b, "__b"), (c, "__c"))])
    base = cut_lineage(base.dropna(), "blend")
    low, high, positives = base.agg(F.least(*[F.min(x) for x in ("__a", "__b", "__c")]), F.greatest(*[F.max(x) for x in ("__a", "__b", "__c")]), F.sum("__y")).first()
    open_ = _triples(steps)
    bins = 0
    while low is not None and len(open_) > BLEND_FINAL:
        finer = min(1 << 16, max(64, BLEND_CELLS // len(open_)))
        if finer <= bins:
            break
        bins = finer
        least, most = _blend_bounds(base, open_, steps, low, high, bins, positives)
        open_ = open_[most >= least.max()]
    grid = F.array(*[F.struct(F.lit(int(i)).alias("__wi"), F.lit(int(j)).alias("__wj")) for i, j in open_])
    rows = base.select("*", F.inline(grid))
    w1, w2, w3 = _grid_weights(F.col("__wi"), F.col("__wj"), steps)
    rows = rows.select("__wi", "__wj", "__y", (w1 * F.col("__a") + w2 * F.col("__b") + w3 * F.col("__c")).alias("__s"))
    cuts = best_cut(rows, by=["__wi", "__wj"], score="__s", label="__y", hot_rows=hot_rows)
    top = cuts.agg(F.min(F.struct((-F.col("correct")).alias("nc"), F.col("__wi"), F.col("__wj"), F.col("cut"), F.col("n"))).alias("t"))
    wi, wj = F.col("t.__wi"), F.col("t.__wj")
    w1, w2, w3 = _grid_weights(wi, wj, steps)
    return top.select(w1.alias(f"w_{a}"), w2.alias(f"w_{b}"), w3.alias(f"w_{c}"), F.col("t.cut").alias("cut"),
                      (-F.col("t.nc")).alias("correct"), F.col("t.n").alias("n"), ((-F.col("t.nc")) / F.col("t.n")).alias("accuracy"))


def grid_errors(wide: DataFrame, models: Sequence[str], label: str = "y", steps: int = 100) -> DataFrame:
    """Mean and mean squared error of every blend of three score columns on the
    grid, ``(w_<m>..., mean, squared_error)``: the one row of score moments joined
    with all weight triples (i, j >= 1, i + j <= steps - 1), so the rows are read once."""
    cols = {f"__{i}": F.col(m).cast("double") for i, m in enumerate(models)} | {"__3": F.col(label).cast("double")}
    names = list(cols)
    rows = wide.select(*[v.alias(k) for k, v in cols.items()])
    pairs = [(x, z) for i, x in enumerate(names) for z in names[i:]]
    moments = rows.agg(*[F.avg(x).alias(f"m{x}") for x in names], *[F.avg(F.col(x) * F.col(z)).alias(f"p{x}{z}") for x, z in pairs])
    triples = weight_grid(rows.sparkSession.range(1).select(F.lit(1).alias("one")), steps)
    both = triples.join(F.broadcast(moments), F.col("__wi") + F.col("__wj") <= steps - 1, "inner")
    w = [*_grid_weights(F.col("__wi"), F.col("__wj"), steps), F.lit(-1.0)]
    mean = sum((w[i] * F.col(f"m{names[i]}") for i in range(1, 3)), w[0] * F.col(f"m{names[0]}"))
    error = F.lit(0.0)
    for x, z in pairs:
        i, j = names.index(x), names.index(z)
        error = error + (1.0 if i == j else 2.0) * w[i] * w[j] * F.col(f"p{x}{z}")
    return both.select(*[v.alias(f"w_{m}") for m, v in zip(models, w)], mean.alias("mean"), error.alias("squared_error"))


def stack_columns(long: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long ``(keys, name, value)`` to one row for each key with a column for
    each of ``names``, matched by key and never by position.  ``whole`` tells
    whether each name came exactly once; a name that came twice gives its
    largest value, a missing one null."""
    aggs = [F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names]
    once = [F.count_if(F.col(name) == n) == 1 for n in names]
    whole = once[0]
    for o in once[1:]:
        whole = whole & o
    return long.groupBy(*keys).agg(*aggs, whole.alias("whole"))


def stack_faults(long: DataFrame, keys: Sequence[str], name: str, names: Sequence[str]) -> DataFrame:
    """Keys at which a name is missing or doubled: ``(keys, name, n)``."""
    counts = long.groupBy(*keys).agg(*[F.count_if(F.col(name) == n).alias(n) for n in names])
    return counts.unpivot(list(keys), list(names), name, "n").where("n != 1")


def group_cuts(scores: DataFrame, group: str, default_cut: float | Column, min_count: int = 100, score: str = "p",
               label: str = "y", missing: str = "Unknown") -> DataFrame:
    """Per-group cut for groups with at least ``min_count`` rows, the default
    cut for smaller ones; NULL group values form the group ``missing``.
    Returns ``(group, n, cut)``."""
    g = scores.withColumn("__g", F.coalesce(F.col(group).cast("string"), F.lit(missing)))
    cuts = best_cut(g, by=["__g"], score=score, label=label)
    d = default_cut if isinstance(default_cut, Column) else F.lit(float(default_cut))
    return cuts.select(F.col("__g").alias("group"), "n",
                       F.when(F.col("n") >= min_count, F.col("cut")).otherwise(d).alias("cut"))


def apply_cuts(scores: DataFrame, group: str, cuts: DataFrame, default_cut: float | Column, score: str = "p",
               out: str = "decision", missing: str = "Unknown") -> DataFrame:
    """Decision ``p > cut`` with the group's cut, the default for a group not
    in ``cuts`` (null group = ``missing``)."""
    d = default_cut if isinstance(default_cut, Column) else F.lit(float(default_cut))
    g = scores.withColumn("__g", F.coalesce(F.col(group).cast("string"), F.lit(missing)))
    j = g.join(cuts.select(F.col("group").alias("__g"), F.col("cut").alias("__cut")), "__g", "left")
    return j.withColumn(out, F.col(score) > F.coalesce(F.col("__cut"), d)).drop("__g", "__cut")


def decisions(scores: DataFrame, cut: float | Column, score: str = "p", out: str = "decision") -> DataFrame:
    c = cut if isinstance(cut, Column) else F.lit(float(cut))
    return scores.withColumn(out, F.col(score) > c)


def pick_calibration(scores: DataFrame, candidates: Sequence[str], default_cut: float, base_accuracy: float,
                     min_count: int = 100, score: str = "p", label: str = "y") -> DataFrame:
    """Evaluate per-group calibration for each candidate column (all in one
    pass over the unpivoted ``(candidate, group)`` pairs) and keep the first
    candidate whose accuracy strictly beats ``base_accuracy`` and every
    earlier candidate.  Returns ``(candidate, accuracy, rank)`` for all
    candidates; ``chosen`` is true for at most one."""
    long = scores.select(score, label, *[F.col(c).cast("string").alias(c) for c in candidates])
    long = long.unpivot([score, label], list(candidates), "candidate", "group").withColumn(
        "group", F.coalesce(F.col("group"), F.lit("Unknown")))
    cuts = best_cut(long, by=["candidate", "group"], score=score, label=label)
    at_default = long.groupBy("candidate", "group").agg(
        F.count_if((F.col(score) > F.lit(float(default_cut))) == (F.col(label) == 1)).alias("plain"))
    right = F.when(F.col("n") >= min_count, F.col("correct")).otherwise(F.col("plain"))
    acc = cuts.join(at_default, ["candidate", "group"]).groupBy("candidate").agg((F.sum(right) / F.sum("n")).alias("accuracy"))
    order = F.create_map(*[x for i, c in enumerate(candidates) for x in (F.lit(c), F.lit(i))])
    acc = acc.withColumn("rank", order[F.col("candidate")])
    best = acc.where(F.col("accuracy") > base_accuracy).agg(
        F.min(F.struct((-F.col("accuracy")).alias("na"), F.col("rank").alias("r"))).alias("b"))
    return attach_row(acc, best).select("candidate", "accuracy", "rank",
                                        F.coalesce(F.col("rank") == F.col("b.r"), F.lit(False)).alias("chosen"))

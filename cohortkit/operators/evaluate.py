"""Evaluation of long score tables ``(id, model, y, p)``: confusion counts,
accuracy / precision / recall / F1 / log loss at a cut, exact ROC-AUC with
tied scores, ROC points, reliability bins, simple-average ensemble, leaders
per metric.  Every metric for every model comes from grouped aggregations
over ``model``; running sums use the skew-safe ``prefix_sums``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.impute import attach_row
from cohortkit.operators.windows import prefix_sums, row_ranks

__all__ = ["confusion", "metrics", "auc", "roc_points", "reliability", "average_model", "against_average", "with_times", "cost_ranks", "leaders",
           "EPS"]

# Fixed value: probabilities are clipped to [EPS, 1 - EPS] before the logarithm.
EPS = 2.220446049250313e-16


def _pred(cut: float):
    return F.col("p") >= F.lit(cut)


def confusion(scores: DataFrame, cut: float = 0.5) -> DataFrame:
    """``(model, tn, fp, fn, tp)`` at ``p >= cut``."""
    y1, p1 = F.col("y") == 1, _pred(cut)
    return scores.groupBy("model").agg(
        F.count_if(~y1 & ~p1).alias("tn"), F.count_if(~y1 & p1).alias("fp"),
        F.count_if(y1 & ~p1).alias("fn"), F.count_if(y1 & p1).alias("tp"))


def auc(scores: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Exact ROC-AUC per model by the rank-sum formula with average ranks for
    tied scores: ``(model, auc)``."""
    c = scores.groupBy("model", "p").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("pos"))
    c = prefix_sums(c, ["model"], ["p"], {"below": "n"}, inclusive=False, hot_rows=hot_rows)
    c = c.withColumn("avg_rank", F.col("below") + (F.col("n") + 1) / 2.0)
    g = c.groupBy("model").agg(F.sum(F.col("pos") * F.col("avg_rank")).alias("rs"), F.sum("pos").alias("np"),
                               F.sum("n").alias("nn"))
    npos, nneg = F.col("np").cast("double"), (F.col("nn") - F.col("np")).cast("double")
    return g.select("model", ((F.col("rs") - npos * (npos + 1) / 2.0) / (npos * nneg)).alias("auc"))


def metrics(scores: DataFrame, cut: float = 0.5) -> DataFrame:
    """One row per model: accuracy, precision, recall, f1 (0 on a zero
    division), roc_auc, log_loss (clipped), confusion counts."""
    y1, p1 = F.col("y") == 1, _pred(cut)
    pc = F.least(F.greatest(F.col("p"), F.lit(EPS)), F.lit(1 - EPS))
    ll = -(F.col("y") * F.log(pc) + (1 - F.col("y")) * F.log(1 - pc))
    m = scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~y1 & ~p1).alias("tn"), F.count_if(~y1 & p1).alias("fp"),
        F.count_if(y1 & ~p1).alias("fn"), F.count_if(y1 & p1).alias("tp"), F.avg(ll).alias("log_loss"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    m = m.select("model", ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"), prec.cast("double").alias("precision"),
                 rec.cast("double").alias("recall"), f1.cast("double").alias("f1"), "log_loss", "tn", "fp", "fn", "tp")
    return m.join(auc(scores), "model")


def roc_points(scores: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """ROC curve per model: one point per distinct score, from the highest
    score down: ``(model, threshold, fpr, tpr)`` plus the origin."""
    c = scores.groupBy("model", "p").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("pos"))
    c = c.withColumn("neg", F.col("n") - F.col("pos"))
    c = prefix_sums(c, ["model"], [F.col("p").desc()], {"ctp": "pos", "cfp": "neg"}, hot_rows=hot_rows)
    tot = c.groupBy("model").agg(F.sum("pos").alias("__tp"), F.sum("neg").alias("__tn"))
    pts = c.join(tot, "model").select("model", F.col("p").alias("threshold"), (F.col("cfp") / F.col("__tn")).alias("fpr"),
                                      (F.col("ctp") / F.col("__tp")).alias("tpr"))
    origin = tot.select("model", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def reliability(scores: DataFrame, bins: int = 11, min_rows: int = 20) -> DataFrame:
    """Equal-width bins on [0, 1): bin i holds ``i/b <= p < (i+1)/b`` (p = 1
    falls in none); bins with more than ``min_rows`` rows report the bin
    centre, mean score and observed positive rate."""
    edges = [i / bins for i in range(bins + 1)]
    b = F.lit(None).cast("int")
    for i in range(bins - 1, -1, -1):
        b = F.when((F.col("p") >= edges[i]) & (F.col("p") < edges[i + 1]), F.lit(i)).otherwise(b)
    s = scores.withColumn("bin", b).where(F.col("bin").isNotNull())
    g = s.groupBy("model", "bin").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("observed"), F.avg("p").alias("mean_p"))
    centre = (F.col("bin") * 2 + 1) / (2.0 * bins)
    return g.where(F.col("n") > min_rows).select("model", "bin", centre.alias("centre"), "n", "mean_p", "observed")


def average_model(scores: DataFrame, name: str = "average", models: Sequence[str] | None = None) -> DataFrame:
    """Simple-average ensemble as a new model in the long table."""
    s = scores if models is None else scores.where(F.col("model").isin(list(models)))
    return s.groupBy("id").agg(F.first("y").alias("y"), F.avg("p").alias("p")).select("id", F.lit(name).alias("model"), "y", "p")


def with_times(metric_table: DataFrame, times: DataFrame) -> DataFrame:
    """Left join of per-model metrics with per-model training times."""
    return metric_table.join(times, "model", "left")


def cost_ranks(times: DataFrame, cost: str, out: str = "cost_rank") -> DataFrame:
    """``times`` with each model's place by a cost column, the cheapest first
    (from 1; ties by name; a null cost comes last)."""
    known = row_ranks(times, [], [F.col(cost).asc_nulls_last(), F.col("model")], out)
    return known.withColumn(out, (F.col(out) + 1).cast("int"))


def against_average(scores: DataFrame, name: str = "average") -> DataFrame:
    """The metrics of every model and of their simple average, with each
    single model's ``place`` by accuracy (from 1, ties by name; null for the
    average) and ``behind``, what it lacks to the average's accuracy."""
    long = scores.select("id", "model", "y", "p")
    table = metrics(long.unionByName(average_model(long, name)))
    is_average = F.col("model") == F.lit(name)
    ranked = row_ranks(table, [], [is_average, F.col("accuracy").desc(), F.col("model")], "place")
    ranked = ranked.withColumn("place", F.when(~is_average, F.col("place") + 1).cast("int"))
    average = table.where(is_average).agg(F.max("accuracy").alias("__a"))
    return attach_row(ranked, average).withColumn("behind", F.col("__a") - F.col("accuracy")).drop("__a")


def leaders(metric_table: DataFrame, higher: Sequence[str] = ("accuracy", "precision", "recall", "f1", "auc"),
            lower: Sequence[str] = ("log_loss",)) -> DataFrame:
    """Best and worst model per metric (max is best, min for the ``lower``
    ones, such as a loss or a time; ties -> the alphabetically first model; null
    metrics don't count): ``(metric, model, value, worst_model, worst_value)``."""
    cols = list(higher) + list(lower)
    long = metric_table.select("model", *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(["model"], cols, "metric", "value")
    sign = F.when(F.col("metric").isin(list(lower)), F.lit(1.0)).otherwise(F.lit(-1.0))
    place = sign * F.col("value")
    best = long.where("value is not null").groupBy("metric").agg(
        F.min(F.struct(place.alias("k"), F.col("model").alias("m"), "value")).alias("b"),
        F.min(F.struct((-place).alias("k"), F.col("model").alias("m"), "value")).alias("w"))
    return best.select("metric", F.col("b.m").alias("model"), F.col("b.value").alias("value"), F.col("w.m").alias("worst_model"), F.col("w.value").alias("worst_value"))

"""Checked queries: evaluation of long score tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import float32, register
from checks.sqlgen import with_views
from cohortkit.operators import evaluate as EV
from cohortkit.operators import stats as ST
from cohortkit.plans.views import long_scores, scores

EPS = "2.220446049250313e-16"
CONF = ("count_if(y = 0 AND p < 0.5) AS tn, count_if(y = 0 AND p >= 0.5) AS fp, "
        "count_if(y = 1 AND p < 0.5) AS fn, count_if(y = 1 AND p >= 0.5) AS tp")


def _auc_cte(src: str = "long_scores") -> str:
    return f"""
auc_c AS (SELECT model, p, count(*) AS n, sum(y) AS pos FROM {src} GROUP BY model, p),
auc_r AS (SELECT model, pos, coalesce(sum(n) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  + (n + 1) / 2.0 AS avg_rank, n FROM auc_c),
auc AS (SELECT model, (sum(pos * avg_rank) - sum(pos) * (sum(pos) + 1) / 2.0) / (CAST(sum(pos) AS DOUBLE) * (sum(n) - sum(pos))) AS auc
  FROM auc_r GROUP BY model)"""


def _metrics_cte(src: str = "long_scores") -> str:
    return _auc_cte(src) + f""",
mc AS (SELECT model, count(*) AS n, {CONF},
  avg(-(y * ln(least(greatest(p, {EPS}), 1 - {EPS})) + (1 - y) * ln(1 - least(greatest(p, {EPS}), 1 - {EPS})))) AS log_loss
  FROM {src} GROUP BY model),
metrics AS (SELECT mc.model, (tp + tn) / n AS accuracy,
  coalesce(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 0.0) AS precision,
  coalesce(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 0.0) AS recall,
  coalesce(CASE WHEN 2 * tp + fp + fn = 0 THEN NULL ELSE 2 * tp / (2 * tp + fp + fn) END, 0.0) AS f1,
  log_loss, tn, fp, fn, tp, auc.auc FROM mc JOIN auc ON mc.model = auc.model)"""


MET_COLS = "model, CAST(accuracy AS FLOAT) AS accuracy, CAST(precision AS FLOAT) AS precision, CAST(recall AS FLOAT) AS recall, " \
           "CAST(f1 AS FLOAT) AS f1, CAST(log_loss AS FLOAT) AS log_loss, tn, fp, fn, tp, CAST(auc AS FLOAT) AS auc"


@register("ev_confusion", with_views(f"SELECT model, {CONF} FROM long_scores GROUP BY model", scores=True))
def q_ev_confusion(spark, sf):
    return EV.confusion(long_scores(spark, sf))


@register("ev_metrics", with_views(f"SELECT {MET_COLS} FROM metrics", _metrics_cte(), scores=True))
def q_ev_metrics(spark, sf):
    return float32(EV.metrics(long_scores(spark, sf)))


@register("ev_auc", with_views("SELECT model, CAST(auc AS FLOAT) AS auc FROM auc", _auc_cte(), scores=True))
def q_ev_auc(spark, sf):
    return float32(EV.auc(long_scores(spark, sf)))


@register("ev_roc", with_views("""
SELECT model, p AS threshold, CAST(cfp / nn AS FLOAT) AS fpr, CAST(ctp / np AS FLOAT) AS tpr FROM (
  SELECT model, p, sum(pos) OVER w AS ctp, sum(n - pos) OVER w AS cfp, sum(pos) OVER (PARTITION BY model) AS np,
    sum(n - pos) OVER (PARTITION BY model) AS nn
  FROM (SELECT model, p, count(*) AS n, sum(y) AS pos FROM long_scores GROUP BY model, p)
  WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
UNION ALL SELECT DISTINCT model, 'inf'::DOUBLE, 0.0, 0.0 FROM long_scores""", scores=True))
def q_ev_roc(spark, sf):
    return float32(EV.roc_points(long_scores(spark, sf)), ["fpr", "tpr"])


@register("ev_reliability", with_views("""
SELECT model, bin, CAST((bin * 2 + 1) / 22.0 AS FLOAT) AS centre, n, CAST(mean_p AS FLOAT) AS mean_p, CAST(observed AS FLOAT) AS observed FROM (
  SELECT model, bin, count(*) AS n, avg(y) AS observed, avg(p) AS mean_p FROM (
    SELECT model, y, p, CASE """ + " ".join(f"WHEN p >= {i / 11!r} AND p < {(i + 1) / 11!r} THEN {i}" for i in range(11)) + """ END AS bin
    FROM long_scores) WHERE bin IS NOT NULL GROUP BY model, bin) WHERE n > 20""", scores=True))
def q_ev_reliability(spark, sf):
    return float32(EV.reliability(long_scores(spark, sf)), ["centre", "mean_p", "observed"])


@register("ev_agreement", with_views(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, CAST(corr({a}, {b}) AS FLOAT) AS r FROM scores WHERE split = 'oof'"
    for a in ("p_a", "p_b", "p_c") for b in ("p_a", "p_b", "p_c")), scores=True))
def q_ev_agreement(spark, sf):
    s = scores(spark, sf).where(F.col("split") == "oof")
    return float32(ST.corr_matrix(s, ["p_a", "p_b", "p_c"], lower=False), ["r"])


_AVG = "avg_scores AS (SELECT id, 'average' AS model, first(y) AS y, avg(p) AS p FROM long_scores GROUP BY id)"


_BOTH = "both_scores AS (SELECT id, model, y, p FROM long_scores UNION ALL SELECT id, model, y, p FROM avg_scores)"


@register("ev_simple_avg", with_views(
    f"SELECT {MET_COLS}, CASE WHEN model <> 'average' THEN CAST(row_number() OVER (PARTITION BY model = 'average' ORDER BY metrics.accuracy DESC, model) AS INTEGER) END AS place, "
    "CAST((SELECT max(accuracy) FROM metrics WHERE model = 'average') - metrics.accuracy AS FLOAT) AS behind FROM metrics",
    _AVG, _BOTH, _metrics_cte("both_scores"), scores=True))
def q_ev_simple_avg(spark, sf):
    return float32(EV.against_average(long_scores(spark, sf)))


_TIMES = "times AS (SELECT model, count(*) AS rows_scored, sum(p) AS score_mass FROM long_scores WHERE model <> 'c' GROUP BY model)"


@register("ev_time_perf", with_views(
    "SELECT m.model, CAST(m.accuracy AS FLOAT) AS accuracy, CAST(m.auc AS FLOAT) AS auc, t.rows_scored, CAST(t.score_mass AS FLOAT) AS score_mass, "
    "CAST(row_number() OVER (ORDER BY t.score_mass ASC NULLS LAST, m.model) AS INTEGER) AS cost_rank "
    "FROM metrics m LEFT JOIN times t ON m.model = t.model", _metrics_cte(), _TIMES, scores=True))
def q_ev_time_perf(spark, sf):
    """Score counts and masses stand in for the times of a training run."""
    ls = long_scores(spark, sf)
    times = ls.where(F.col("model") != "c").groupBy("model").agg(F.count(F.lit(1)).alias("rows_scored"), F.sum("p").alias("score_mass"))
    m = EV.metrics(ls).select("model", "accuracy", "auc")
    return float32(EV.cost_ranks(EV.with_times(m, times), "score_mass"))


@register("join_left", with_views(
    "SELECT m.model, CAST(m.accuracy AS FLOAT) AS accuracy, t.rows_scored FROM metrics m LEFT JOIN times t ON m.model = t.model",
    _metrics_cte(), _TIMES, scores=True))
def q_join_left(spark, sf):
    ls = long_scores(spark, sf)
    times = ls.where(F.col("model") != "c").groupBy("model").agg(F.count(F.lit(1)).alias("rows_scored"))
    return float32(EV.metrics(ls).select("model", "accuracy").join(times, "model", "left"))


_LONG_METRICS = "(UNPIVOT metrics ON accuracy, precision, recall, f1, auc, log_loss INTO NAME metric VALUE value)"


@register("ev_leaders", with_views(f"""
SELECT b.metric, b.model, CAST(b.value AS FLOAT) AS value, w.model AS worst_model, CAST(w.value AS FLOAT) AS worst_value FROM (
  SELECT metric, model, value, row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'log_loss' THEN value ELSE -value END, model) AS rn
  FROM {_LONG_METRICS}) b JOIN (
  SELECT metric, model, value, row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'log_loss' THEN -value ELSE value END, model) AS rn
  FROM {_LONG_METRICS}) w ON b.metric = w.metric WHERE b.rn = 1 AND w.rn = 1""",
    _metrics_cte(), scores=True))
def q_ev_leaders(spark, sf):
    return float32(EV.leaders(EV.metrics(long_scores(spark, sf))), ["value", "worst_value"])

"""Checked queries: thresholds, blending, per-group calibration, decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.features_sql import DECOMPOSE, feature_ctes
from checks.registry import float32, register
from checks.sqlgen import with_views
from cohortkit.operators import ensemble as EN
from cohortkit.plans import prepare as P
from cohortkit.plans.calibrate import CANDIDATES, calibrated_decisions
from cohortkit.plans.views import long_scores, manifest, scores
from cohortkit.runtime import cut_lineage

WEIGHTS = {"p_a": 0.4, "p_b": 0.4, "p_c": 0.2}
GROUP_MIN = 100


def bestcut_sql(name: str, src: str, by: str) -> str:
    """CTEs ``name`` = (by..., cut, correct, n, accuracy) over ``src(by.., p, y)``."""
    return f"""
{name}_c AS (SELECT {by}, p, count(*) AS n, sum(y) AS pos FROM {src} GROUP BY {by}, p),
{name}_r AS (SELECT {by}, p, sum(n) OVER w AS cn, sum(pos) OVER w AS cpos, sum(n) OVER (PARTITION BY {by}) AS ntot,
  sum(pos) OVER (PARTITION BY {by}) AS ptot FROM {name}_c
  WINDOW w AS (PARTITION BY {by} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name} AS (SELECT {by}, CASE WHEN correct > ptot THEN p ELSE '-inf'::DOUBLE END AS cut,
  CAST(greatest(correct, ptot) AS BIGINT) AS correct, CAST(ntot AS BIGINT) AS n, greatest(correct, ptot) / ntot AS accuracy
  FROM (SELECT *, (cn - cpos) + (ptot - cpos) AS correct,
    row_number() OVER (PARTITION BY {by} ORDER BY (cn - cpos) + (ptot - cpos) DESC, p) AS rn FROM {name}_r) WHERE rn = 1)"""


CAL = f"""
cal AS (SELECT s.PassengerId AS id, CAST(s.Transported AS INTEGER) AS y, 0.4 * s.p_a + 0.4 * s.p_b + 0.2 * s.p_c AS p, s.split,
  d.CabinDeck || '_' || d.CabinSide AS DeckSide, d.CabinDeck, d.Destination, d.HomePlanet || '_' || d.Destination AS HomeDestination,
  'all' AS g FROM scores s JOIN d0 d ON s.PassengerId = d.PassengerId),
oof AS (SELECT * FROM cal WHERE split = 'oof'),
grp AS (SELECT coalesce(HomeDestination, 'Unknown') AS grp, p, y FROM oof)"""


def _cal_frames(spark, sf):
    d = P.decompose(manifest(spark, sf, spend=False)).select(
        "PassengerId", F.concat("CabinDeck", F.lit("_"), "CabinSide").alias("DeckSide"), "CabinDeck", "Destination",
        F.concat("HomePlanet", F.lit("_"), "Destination").alias("HomeDestination"))
    s = scores(spark, sf).join(d, "PassengerId").withColumn("y", F.col("Transported").cast("int"))
    s = EN.blend(s, WEIGHTS, out="p").withColumnRenamed("PassengerId", "id")
    return s.where("split = 'oof'"), s.where("split = 'test'")


#: As ``cal``, with the six candidates of the imputed and engineered features.
CAL6 = """
cal AS (SELECT s.PassengerId AS id, CAST(s.Transported AS INTEGER) AS y, 0.4 * s.p_a + 0.4 * s.p_b + 0.2 * s.p_c AS p, s.split, 'all' AS g,
  f.DeckSide, f.CabinDeck, f.Destination, f.HomeDestination, f.CryoHome, CAST(f.ServicesUsed AS VARCHAR) AS ServicesUsed FROM scores s JOIN feat f ON s.PassengerId = f.PassengerId),
oof AS (SELECT * FROM cal WHERE split = 'oof')"""


def _feature_frames(spark, sf):
    d = P.build_features(manifest(spark, sf)).select("PassengerId", *CANDIDATES)
    s = scores(spark, sf).join(d, "PassengerId").withColumn("y", F.col("Transported").cast("int"))
    s = EN.blend(s, WEIGHTS, out="p").withColumnRenamed("PassengerId", "id")
    s = cut_lineage(s.select("id", "y", "p", "split", *CANDIDATES), "calibration")
    return s.where("split = 'oof'"), s.where("split = 'test'")


def _global(oof):
    return EN.best_cut(oof).first()


@register("ens_threshold", with_views(
    "SELECT model, cut, correct, n, CAST(accuracy AS FLOAT) AS accuracy FROM bc", bestcut_sql("bc", "long_scores", "model"), scores=True))
def q_ens_threshold(spark, sf):
    return float32(EN.best_cut(long_scores(spark, sf), by=["model"]), ["accuracy"])


_BLEND_SRC = """
grid AS (SELECT i, j, CAST(Transported AS INTEGER) AS y,
  (CAST(i AS DOUBLE) / 100) * p_a + (CAST(j AS DOUBLE) / 100) * p_b + (CAST(100 - i - j AS DOUBLE) / 100) * p_c AS p
  FROM scores, range(1, 99) a(i), range(1, 99) b(j) WHERE i + j <= 99 AND split = 'oof'),
gr AS (SELECT i, j, p, y, count(*) OVER w AS cn, sum(y) OVER w AS cpos, sum(y) OVER (PARTITION BY i, j) AS ptot FROM grid
  WINDOW w AS (PARTITION BY i, j ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
gb AS (SELECT i, j, cut, correct FROM (SELECT i, j, CASE WHEN (cn - cpos) + (ptot - cpos) > ptot THEN p ELSE '-inf'::DOUBLE END AS cut,
  greatest((cn - cpos) + (ptot - cpos), ptot) AS correct,
  row_number() OVER (PARTITION BY i, j ORDER BY (cn - cpos) + (ptot - cpos) DESC, p) AS rn FROM gr) WHERE rn = 1)"""


@register("ens_blend", with_views("""
SELECT CAST(i AS DOUBLE) / 100 AS w_p_a, CAST(j AS DOUBLE) / 100 AS w_p_b, CAST(100 - i - j AS DOUBLE) / 100 AS w_p_c, cut,
  CAST(correct AS BIGINT) AS correct, (SELECT count(*) FROM scores WHERE split = 'oof') AS n,
  CAST(correct / (SELECT count(*) FROM scores WHERE split = 'oof') AS FLOAT) AS accuracy
FROM gb ORDER BY correct DESC, i, j LIMIT 1""", _BLEND_SRC, scores=True))
def q_ens_blend(spark, sf):
    s = scores(spark, sf).where("split = 'oof'").withColumn("y", F.col("Transported").cast("int"))
    return float32(EN.tune_blend(s, ["p_a", "p_b", "p_c"], "y", steps=100), ["accuracy"])


_GROUP_CUTS = (CAL + "," + bestcut_sql("gbc", "grp", "grp") + "," + bestcut_sql("allcut", "oof", "g") + f""",
gcut AS (SELECT grp AS "group", n, CASE WHEN n >= {GROUP_MIN} THEN cut ELSE (SELECT cut FROM allcut) END AS cut FROM gbc)""")


@register("ens_group_thr", with_views('SELECT "group", n, cut FROM gcut', DECOMPOSE, _GROUP_CUTS, scores=True))
def q_ens_group_thr(spark, sf):
    oof, _ = _cal_frames(spark, sf)
    return EN.group_cuts(oof, "HomeDestination", float(_global(oof)["cut"]), min_count=GROUP_MIN)


@register("ens_apply_thr", with_views(
    "SELECT c.id, c.p > coalesce(g.cut, (SELECT cut FROM allcut)) AS decision FROM cal c LEFT JOIN gcut g "
    "ON coalesce(c.HomeDestination, 'Unknown') = g.\"group\" WHERE c.split = 'test'", DECOMPOSE, _GROUP_CUTS, scores=True))
def q_ens_apply_thr(spark, sf):
    oof, test = _cal_frames(spark, sf)
    cut = float(_global(oof)["cut"])
    cuts = EN.group_cuts(oof, "HomeDestination", cut, min_count=GROUP_MIN)
    return EN.apply_cuts(test, "HomeDestination", cuts, cut).select("id", "decision")


def _select_sql() -> str:
    parts = []
    for r, c in enumerate(CANDIDATES):
        parts.append(f"""
cs{r}_src AS (SELECT coalesce({c}, 'Unknown') AS grp, p, y FROM oof),
{bestcut_sql(f"cs{r}", f"cs{r}_src", "grp").strip()},
acc{r} AS (SELECT '{c}' AS candidate, {r} AS "rank", count_if((o.p > CASE WHEN b.n >= 100 THEN b.cut ELSE (SELECT cut FROM allcut) END) = (o.y = 1))
  / count(*) AS accuracy FROM cs{r}_src o JOIN cs{r} b ON o.grp = b.grp)""")
    return ",".join(parts) + ",\naccs AS (" + " UNION ALL ".join(f"SELECT * FROM acc{r}" for r in range(len(CANDIDATES))) + ")"


_SELECT = CAL6 + "," + bestcut_sql("allcut", "oof", "g") + "," + _select_sql()


@register("ens_select_cal", with_views("""
SELECT candidate, CAST(accuracy AS FLOAT) AS accuracy, "rank",
  coalesce("rank" = (SELECT "rank" FROM accs WHERE accuracy > (SELECT accuracy FROM allcut) ORDER BY accuracy DESC, "rank" LIMIT 1), false) AS chosen
FROM accs""", *feature_ctes(), _SELECT, scores=True))
def q_ens_select_cal(spark, sf):
    oof, _ = _feature_frames(spark, sf)
    g = _global(oof)
    return float32(EN.pick_calibration(oof, CANDIDATES, float(g["cut"]), float(g["accuracy"]), min_count=100), ["accuracy"])


@register("ens_submit", with_views("""
SELECT t.id, CASE WHEN ch.candidate IS NULL THEN t.p > (SELECT cut FROM allcut)
  ELSE t.p > coalesce(CASE ch.candidate """ + " ".join(
    f"WHEN '{c}' THEN (SELECT CASE WHEN n >= 100 THEN cut ELSE (SELECT cut FROM allcut) END FROM cs{r} WHERE cs{r}.grp = coalesce(t.{c}, 'Unknown'))"
    for r, c in enumerate(CANDIDATES)) + """ END, (SELECT cut FROM allcut)) END AS decision
FROM (SELECT * FROM cal WHERE split = 'test') t
LEFT JOIN (SELECT candidate FROM accs WHERE accuracy > (SELECT accuracy FROM allcut) ORDER BY accuracy DESC, "rank" LIMIT 1) ch ON TRUE""",
    *feature_ctes(), _SELECT, scores=True))
def q_ens_submit(spark, sf):
    oof, test = _feature_frames(spark, sf)
    out, _ = calibrated_decisions(oof, test, {"p": 1.0}, CANDIDATES, label="y", id_col="id", min_count=100)
    return out

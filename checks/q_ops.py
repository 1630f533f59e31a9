"""Checked queries: sources/sinks, projections, row operators, aggregations,
profiling, windows, joins, set operations, encoders, splits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.features_sql import DECOMPOSE, PRECOUNTS, known, rsum
from checks.registry import float32, register
from checks.sqlgen import SPEND, with_views
from cohortkit.functions import columns as C
from cohortkit.operators import encode as EN
from cohortkit.operators import ensemble as ENS
from cohortkit.operators import features as FE
from cohortkit.operators import impute as IM
from cohortkit.operators import profile as PR
from cohortkit.operators import splits as SP
from cohortkit.operators import stats as ST
from cohortkit.operators import windows as WN
from cohortkit.plans import prepare as P
from cohortkit.plans.views import long_scores, manifest, scores, table
from cohortkit.runtime import cut_lineage, scratch_path
from cohortkit.sources import io as IO

M_COLS = ["PassengerId", "HomePlanet", "CryoSleep", "Cabin", "Destination", "Age", "VIP", *SPEND, "Name", "Transported", "is_train"]
MANIFEST_SCHEMA = ("PassengerId string, HomePlanet string, CryoSleep boolean, Cabin string, Destination string, Age double, "
                   "VIP boolean, RoomService double, FoodCourt double, ShoppingMall double, Spa double, VRDeck double, "
                   "Name string, Transported boolean, is_train boolean")


def _m(spark, sf):
    return manifest(spark, sf)


def _train(spark, sf):
    return manifest(spark, sf).where(F.col("is_train"))


def _slim(spark, sf):
    """The manifest for plans without a spend column: lineitem isn't read."""
    return manifest(spark, sf, spend=False)


def _slim_train(spark, sf):
    return _slim(spark, sf).where(F.col("is_train"))


def _d0(spark, sf):
    return P.decompose(manifest(spark, sf))


TRAIN = "(SELECT * FROM manifest WHERE is_train)"


# ---- 2.1 sources and sinks ---------------------------------------------------------------------
@register("src_csv", with_views("SELECT * FROM manifest"))
def q_src_csv(spark, sf):
    path = scratch_path(spark, "manifest_csv")
    IO.write_table(_m(spark, sf), path, fmt="csv")
    return IO.read_table(spark, path, fmt="csv", schema=MANIFEST_SCHEMA)


@register("src_prob", with_views("SELECT id, y, model, p FROM long_scores", scores=True))
def q_src_prob(spark, sf):
    return long_scores(spark, sf)


@register("src_opt", "SELECT doc_id, quality, toxic FROM labels")
def q_src_opt(spark, sf):
    schema = "doc_id long, quality int, toxic int"
    present = IO.read_optional(spark, f"{sf}/labels.parquet", schema)
    absent = IO.read_optional(spark, f"{sf}/no_such_table.parquet", schema)
    return present.unionByName(absent)


@register("snk_table", with_views("SELECT * FROM manifest"))
def q_snk_table(spark, sf):
    path = scratch_path(spark, "manifest_parquet")
    IO.write_table(_m(spark, sf), path, partition_by=["is_train"])
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path).select(*M_COLS)


# ---- 2.2 projections and scalar operators ------------------------------------------------------
@register("prj_select", with_views("SELECT PassengerId AS id, Transported AS label, Age, HomePlanet FROM manifest"))
def q_prj_select(spark, sf):
    df = _slim(spark, sf).drop("Name").withColumnRenamed("PassengerId", "id").withColumnRenamed("Transported", "label")
    return df.select("id", "label", "Age", "HomePlanet")


@register("prj_by_type", with_views(f"SELECT Age, {', '.join(SPEND)} FROM manifest"))
def q_prj_by_type(spark, sf):
    return FE.select_numeric(_m(spark, sf))


@register("num_coerce", with_views(
    "SELECT PassengerId, coalesce(CabinNum, (SELECT median(CabinNum) FROM d0)) AS CabinNum, "
    "coalesce(Age, (SELECT median(Age) FROM d0)) AS Age FROM d0", DECOMPOSE))
def q_num_coerce(spark, sf):
    return FE.clean_numeric(_d0(spark, sf).select("PassengerId", "CabinNum", "Age"), ["CabinNum", "Age"])


@register("prj_cast", with_views(
    "SELECT PassengerId, coalesce(CASE WHEN CryoSleep THEN 'True' WHEN NOT CryoSleep THEN 'False' END, 'Unknown') AS CryoSleep, "
    "coalesce(CASE WHEN VIP THEN 'True' WHEN NOT VIP THEN 'False' END, 'Unknown') AS VIP, coalesce(HomePlanet, 'Unknown') AS HomePlanet, "
    "CAST(CAST(Age AS INTEGER) AS VARCHAR) AS AgeText FROM manifest"))
def q_prj_cast(spark, sf):
    df = FE.stringify(_slim(spark, sf), ["CryoSleep", "VIP", "HomePlanet"])
    return df.select("PassengerId", "CryoSleep", "VIP", "HomePlanet", F.col("Age").cast("int").cast("string").alias("AgeText"))


@register("prj_fill_const", with_views(
    "SELECT PassengerId, coalesce(HomePlanet, 'Missing') AS HomePlanet, coalesce(VIP, false) AS VIP, "
    "coalesce(RoomService, 0.0) AS RoomService FROM manifest"))
def q_prj_fill_const(spark, sf):
    return FE.fill_const(_m(spark, sf), {"HomePlanet": "Missing", "VIP": False, "RoomService": 0.0}).select(
        "PassengerId", "HomePlanet", "VIP", "RoomService")


@register("prj_map_lookup", with_views(
    "SELECT PassengerId, CabinDeck, CASE CabinDeck WHEN 'A' THEN 'Europa' WHEN 'B' THEN 'Europa' WHEN 'C' THEN 'Europa' "
    "WHEN 'T' THEN 'Europa' WHEN 'G' THEN 'Earth' END AS DeckHome FROM d0", DECOMPOSE))
def q_prj_map_lookup(spark, sf):
    return FE.map_values(_d0(spark, sf), "CabinDeck", P.DECK_HOME, out="DeckHome").select("PassengerId", "CabinDeck", "DeckHome")


@register("prj_cond_update", with_views(
    "SELECT PassengerId, CASE WHEN coalesce(Age < 18, false) THEN false ELSE VIP END AS VIP FROM manifest"))
def q_prj_cond_update(spark, sf):
    return IM.update_where(_slim(spark, sf), "VIP", F.col("Age") < 18, False).select("PassengerId", "VIP")


@register("prd_null_flags", with_views(
    "SELECT PassengerId, CAST(Age IS NULL AS INTEGER) AS AgeMissing, CAST(Cabin IS NULL AS INTEGER) AS CabinMissing FROM manifest"))
def q_prd_null_flags(spark, sf):
    return FE.null_flags(_slim(spark, sf), {"Age": "AgeMissing", "Cabin": "CabinMissing"}).select("PassengerId", "AgeMissing", "CabinMissing")


@register("prd_filter", with_views(
    "SELECT PassengerId, Age, RoomService FROM manifest WHERE Age > 30 AND HomePlanet IS NOT NULL "
    "AND Destination IN ('1-URGENT', '2-HIGH') AND RoomService >= 1000 AND RoomService < 50000"))
def q_prd_filter(spark, sf):
    m = _m(spark, sf)
    return m.where((F.col("Age") > 30) & F.col("HomePlanet").isNotNull() & F.col("Destination").isin("1-URGENT", "2-HIGH")
                   & (F.col("RoomService") >= 1000) & (F.col("RoomService") < 50000)).select("PassengerId", "Age", "RoomService")


@register("row_null_count", with_views("SELECT PassengerId, SpendMissingCount, SpendKnownCount FROM d1", DECOMPOSE, PRECOUNTS))
def q_row_null_count(spark, sf):
    return P.pre_counts(_d0(spark, sf)).select("PassengerId", "SpendMissingCount", "SpendKnownCount")


@register("row_sum", with_views(f"SELECT PassengerId, TotalSpendRaw, {rsum()} AS TotalSpend FROM d1", DECOMPOSE, PRECOUNTS))
def q_row_sum(spark, sf):
    return P.pre_counts(_d0(spark, sf)).select("PassengerId", "TotalSpendRaw", C.row_sum(SPEND).alias("TotalSpend"))


_MEAN = f"(CASE WHEN {known()} > 0 THEN {rsum()} / {known()} END)"
_SS = " + ".join(f"coalesce(({c} - {_MEAN}) * ({c} - {_MEAN}), 0.0)" for c in SPEND)


@register("row_stats", with_views(
    f"SELECT PassengerId, CAST({_MEAN} AS FLOAT) AS SpendMean, "
    f"CAST(coalesce(CASE WHEN {known()} > 1 THEN sqrt(({_SS}) / ({known()} - 1)) END, 0.0) AS FLOAT) AS SpendStd, "
    f"greatest({', '.join(SPEND)}) AS SpendMax, least({', '.join(SPEND)}) AS SpendMin FROM manifest"))
def q_row_stats(spark, sf):
    df = FE.row_features(_m(spark, sf), SPEND).select("PassengerId", "SpendMean", "SpendStd", "SpendMax", "SpendMin")
    return float32(df, ["SpendMean", "SpendStd"])


@register("row_count_if", with_views(
    "SELECT PassengerId, (" + " + ".join(f"CAST(coalesce({c} > 0, false) AS INTEGER)" for c in SPEND) + ") AS ServicesUsed FROM manifest"))
def q_row_count_if(spark, sf):
    return _m(spark, sf).select("PassengerId", C.count_positive(SPEND).alias("ServicesUsed"))


@register("num_arith", with_views(
    "SELECT PassengerId, FoodCourt + ShoppingMall AS FoodSpend, RoomService + Spa + VRDeck AS LuxurySpend, "
    "CASE WHEN FoodCourt = 0 THEN NULL ELSE RoomService / FoodCourt END AS RoomPerFood, "
    f"CAST(coalesce({rsum()} = 0, false) AS INTEGER) AS ZeroSpend FROM manifest"))
def q_num_arith(spark, sf):
    m = _m(spark, sf)
    return m.select("PassengerId", (F.col("FoodCourt") + F.col("ShoppingMall")).alias("FoodSpend"),
                    (F.col("RoomService") + F.col("Spa") + F.col("VRDeck")).alias("LuxurySpend"),
                    C.safe_ratio("RoomService", "FoodCourt").alias("RoomPerFood"), C.is_zero(C.row_sum(SPEND)).alias("ZeroSpend"))


@register("num_clip", with_views("SELECT PassengerId, CASE WHEN Age < 18 THEN 18.0 ELSE Age END AS AgeAdult, "
                                 "CASE WHEN GroupNumber < 1 THEN 1.0 ELSE GroupNumber END AS GroupNumberClip FROM d0", DECOMPOSE))
def q_num_clip(spark, sf):
    return _d0(spark, sf).select("PassengerId", C.clip_lower("Age", 18).alias("AgeAdult"), C.clip_lower("GroupNumber", 1).alias("GroupNumberClip"))


@register("str_cross", with_views(
    "SELECT PassengerId, HomePlanet || '_' || Destination AS HomeDestination, CabinDeck || '_' || CabinSide AS DeckSide FROM d0", DECOMPOSE))
def q_str_cross(spark, sf):
    return FE.cross(_d0(spark, sf), {"HomeDestination": ("HomePlanet", "Destination"), "DeckSide": ("CabinDeck", "CabinSide")}).select(
        "PassengerId", "HomeDestination", "DeckSide")


MOM_COLS = ["Age", *SPEND]
_MOM_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, skewness({c}) AS skew, kurtosis({c}) AS kurtosis FROM manifest" for c in MOM_COLS)


@register("num_bin_label", with_views(
    "SELECT \"column\", CASE WHEN abs(skew) > 1.5 THEN 'HIGHLY SKEWED' ELSE '' END AS flag, "
    "CASE WHEN skew < 1e-20 THEN 'VERY STRONG' WHEN skew < 1e-6 THEN 'STRONG' WHEN skew < 0.01 THEN 'MODERATE' ELSE 'weak' END AS band "
    f"FROM ({_MOM_SQL})"))
def q_num_bin_label(spark, sf):
    mo = PR.moments(_m(spark, sf), MOM_COLS)
    return mo.select("column", C.skew_label("skew").alias("flag"), C.strength_label("skew").alias("band"))


@register("lin_combine", with_views(
    "SELECT PassengerId, 0.4 * p_a + 0.4 * p_b + 0.2 * p_c AS p_blend, CAST((p_a + p_b + p_c) / 3 AS FLOAT) AS p_mean FROM scores",
    scores=True))
def q_lin_combine(spark, sf):
    from cohortkit.operators.ensemble import blend

    s = blend(scores(spark, sf), {"p_a": 0.4, "p_b": 0.4, "p_c": 0.2})
    return float32(s.select("PassengerId", "p_blend", ((F.col("p_a") + F.col("p_b") + F.col("p_c")) / 3).alias("p_mean")), ["p_mean"])


# ---- 2.3 aggregations and profiling --------------------------------------------------------------
@register("agg_mode", with_views(
    "SELECT Destination, v AS mode FROM (SELECT Destination, HomePlanet AS v, row_number() OVER (PARTITION BY Destination "
    "ORDER BY count(*) DESC, HomePlanet) AS rn FROM manifest WHERE HomePlanet IS NOT NULL GROUP BY Destination, HomePlanet) WHERE rn = 1 "
    "UNION ALL SELECT Destination, NULL FROM manifest GROUP BY Destination HAVING count(HomePlanet) = 0"))
def q_agg_mode(spark, sf):
    return IM.mode_stats(_slim(spark, sf), "HomePlanet", ["Destination"])


@register("agg_median", with_views(
    "SELECT HomePlanet, median(Age) AS median FROM manifest GROUP BY HomePlanet UNION ALL SELECT 'ALL', median(Age) FROM manifest"))
def q_agg_median(spark, sf):
    m = _slim(spark, sf)
    return IM.median_stats(m, "Age", ["HomePlanet"]).unionByName(
        IM.median_stats(m, "Age", []).select(F.lit("ALL").alias("HomePlanet"), "median"))


@register("agg_value_counts", with_views(
    "SELECT Destination, count(*) AS count, count(*) / sum(count(*)) OVER () AS share FROM manifest "
    "WHERE Destination IS NOT NULL GROUP BY Destination"))
def q_agg_value_counts(spark, sf):
    return PR.value_counts(_slim(spark, sf), "Destination", normalize=True)


@register("agg_group", with_views(
    "SELECT CabinDeck, avg(CAST(Transported AS DOUBLE)) AS mean, count(*) AS count FROM d0 WHERE is_train GROUP BY CabinDeck", DECOMPOSE))
def q_agg_group(spark, sf):
    return PR.group_rates(_d0(spark, sf).where("is_train"), "CabinDeck", "Transported")


_GS = ("gs AS (SELECT d.*, CAST(g.n AS DOUBLE) AS GroupSize FROM d0 d JOIN (SELECT GroupId, count(*) AS n FROM d0 WHERE is_train "
       "GROUP BY GroupId) g ON d.GroupId = g.GroupId WHERE d.is_train)")


@register("agg_cond", with_views(
    "SELECT CAST(avg(CASE WHEN GroupSize = 1 THEN y END) AS FLOAT) AS solo_rate, "
    f"CAST(avg(CASE WHEN {rsum()} = 0 THEN y END) AS FLOAT) AS zero_spend_rate, "
    f"CAST(avg(CASE WHEN {rsum()} <> 0 THEN y END) AS FLOAT) AS nonzero_spend_rate, "
    "CAST((SELECT avg(r) FROM (SELECT avg(CAST(Transported AS DOUBLE)) AS r FROM gs WHERE GroupSize >= 6 AND GroupSize <= 10 "
    "GROUP BY GroupSize)) AS FLOAT) AS large_group_rate "
    "FROM (SELECT *, CAST(Transported AS DOUBLE) AS y FROM gs)", DECOMPOSE, _GS))
def q_agg_cond(spark, sf):
    d = _d0(spark, sf).where("is_train")
    d = FE.group_size(d, "GroupId", "GroupSize")
    total = C.row_sum(SPEND)
    one = FE.cond_means(d, "Transported", {
        "solo_rate": F.col("GroupSize") == 1, "zero_spend_rate": total == 0, "nonzero_spend_rate": total != 0})
    sizes = PR.group_rates(d.where((F.col("GroupSize") >= 6) & (F.col("GroupSize") <= 10)), "GroupSize", "Transported")
    large = sizes.agg(F.avg("mean").alias("large_group_rate"))
    return float32(IM.attach_row(one, large))


@register("prof_overview", with_views(
    "SELECT count(*) AS rows, CAST(sum(CAST(Transported AS INTEGER)) AS BIGINT) AS label_true, "
    "CAST(sum(1 - CAST(Transported AS INTEGER)) AS BIGINT) AS label_false, 14 AS columns, 12 AS features, "
    "(SELECT string_agg(t || ':' || n, ',' ORDER BY t) FROM (SELECT CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS t, count(*) AS n "
    f"FROM (VALUES {', '.join(f'({chr(39)}{t}{chr(39)})' for t in ['VARCHAR'] * 5 + ['DOUBLE'] * 6 + ['BOOLEAN'] * 3)}) v(column_type) GROUP BY 1)) AS types "
    "FROM manifest WHERE is_train"))
def q_prof_overview(spark, sf):
    return PR.overview(_train(spark, sf).drop("is_train"), "Transported")


_DT = {"PassengerId": "string", "HomePlanet": "string", "CryoSleep": "boolean", "Cabin": "string", "Destination": "string",
       "Age": "double", "VIP": "boolean", **{c: "double" for c in SPEND}, "Name": "string", "Transported": "boolean", "is_train": "boolean"}


@register("prof_missing", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, (count(*) - count({c})) / count(*) * 100.0 AS percent, "
    f"'{t}' AS dtype FROM manifest" for c, t in _DT.items())))
def q_prof_missing(spark, sf):
    return PR.missing_report(_m(spark, sf))


PAT_COLS = ["HomePlanet", "CryoSleep", "Cabin", "Destination", "Age", "VIP"]


@register("prof_missing_pattern", with_views(
    "SELECT " + " || ".join(f"CAST(CAST({c} IS NULL AS INTEGER) AS VARCHAR)" for c in PAT_COLS)
    + " AS pattern, count(*) AS rows FROM manifest GROUP BY pattern"))
def q_prof_missing_pattern(spark, sf):
    return PR.missing_pattern(_m(spark, sf), PAT_COLS)


@register("prof_moments", with_views(f"SELECT \"column\", n, CAST(skew AS FLOAT) AS skew, CAST(kurtosis AS FLOAT) AS kurtosis FROM ({_MOM_SQL})"))
def q_prof_moments(spark, sf):
    return float32(PR.moments(_m(spark, sf), MOM_COLS), ["skew", "kurtosis"])


@register("prof_quantile", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.75) AS q75, "
    f"quantile_cont({c}, 0.95) AS q95 FROM manifest" for c in ["Age", "RoomService"])))
def q_prof_quantile(spark, sf):
    return PR.quantiles(_m(spark, sf), ["Age", "RoomService"], [0.25, 0.75, 0.95])


_OUT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", lower, upper, count_if({c} < lower OR {c} > upper) AS outliers, "
    f"CAST(count_if({c} < lower OR {c} > upper) / count({c}) * 100.0 AS FLOAT) AS percent FROM manifest, "
    f"(SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (SELECT quantile_cont({c}, 0.25) AS q1, "
    f"quantile_cont({c}, 0.75) AS q3 FROM manifest)) WHERE {c} IS NOT NULL GROUP BY lower, upper" for c in [*SPEND, "Age"])


@register("prof_outlier", with_views(_OUT_SQL))
def q_prof_outlier(spark, sf):
    return float32(PR.iqr_outliers(_m(spark, sf), [*SPEND, "Age"]), ["percent"])


_BOX_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", b.Transported, q1, median, q3,
      min(CASE WHEN {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1) THEN {c} END) AS whisker_low,
      max(CASE WHEN {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1) THEN {c} END) AS whisker_high,
      count_if(NOT ({c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1))) AS fliers
    FROM {TRAIN} t JOIN (SELECT Transported, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
      quantile_cont({c}, 0.75) AS q3 FROM {TRAIN} GROUP BY Transported) b ON t.Transported = b.Transported
    WHERE {c} IS NOT NULL GROUP BY b.Transported, q1, median, q3""" for c in ["Age", "RoomService"])


@register("prof_box", with_views(_BOX_SQL))
def q_prof_box(spark, sf):
    return PR.box_summary(_train(spark, sf), ["Age", "RoomService"], by="Transported")


def _hist_sql(src: str, cols, bins: int) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", Transported, bin, lo + bin * ((hi - lo) / {bins}) AS "left", count(*) AS n,
          CAST(count(*) / (total * ((hi - lo) / {bins})) AS FLOAT) AS density FROM (
          SELECT t.Transported, lo, hi, total,
            least(greatest(floor(({c} - lo) * ({float(bins)} / (hi - lo))), 0), {bins - 1}) AS bin
          FROM {src} t JOIN (SELECT Transported, CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END AS lo,
            CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END AS hi, count(*) AS total
            FROM {src} WHERE {c} IS NOT NULL GROUP BY Transported) r ON t.Transported = r.Transported
          WHERE {c} IS NOT NULL) GROUP BY Transported, bin, lo, hi, total""")
    return " UNION ALL ".join(parts)


@register("prof_hist", with_views(_hist_sql(TRAIN, ["Age", "RoomService"], 40)))
def q_prof_hist(spark, sf):
    return float32(PR.histogram(_train(spark, sf), ["Age", "RoomService"], by="Transported", bins=40), ["density"])


_CLIPPED = (f"(SELECT t.* FROM {TRAIN} t JOIN (SELECT Transported, quantile_cont(RoomService, 0.95) AS cap FROM {TRAIN} "
            "WHERE RoomService IS NOT NULL GROUP BY Transported) q ON t.Transported = q.Transported WHERE t.RoomService < q.cap)")


@register("prof_clip_hist", with_views(_hist_sql(_CLIPPED, ["RoomService"], 50)))
def q_prof_clip_hist(spark, sf):
    return float32(PR.clipped_histogram(_train(spark, sf), ["RoomService"], by="Transported", bins=50), ["density"])


_KDE_X = "(mn + (mx - mn) * g / 63)"


def _kernel_sql(node: str) -> str:
    return f"exp(-0.5 * pow(({_KDE_X} - (mn + ({node}) * ((mx - mn) / 4096))) / h, 2))"


@register("prof_kde", with_views(f"""
SELECT Transported, g AS point, CAST({_KDE_X} AS FLOAT) AS x,
  CAST(sum((c - w) * {_kernel_sql("node")} + w * {_kernel_sql("node + 1")}) / (n * h * sqrt(2 * pi())) AS FLOAT) AS density
FROM (SELECT Transported, mn, mx, n, h, node, count(*) AS c, sum(u - node) AS w FROM (
    SELECT *, least(floor(u), 4095) AS node FROM (
      SELECT s.*, (Age - mn) / ((mx - mn) / 4096) AS u
      FROM {TRAIN} t JOIN (SELECT Transported, min(Age) AS mn, max(Age) AS mx, count(*) AS n, stddev_samp(Age) * pow(count(*), -0.2) AS h
        FROM {TRAIN} WHERE Age IS NOT NULL GROUP BY Transported) s ON t.Transported = s.Transported WHERE Age IS NOT NULL))
  GROUP BY Transported, mn, mx, n, h, node)
CROSS JOIN range(0, 64) r(g)
GROUP BY Transported, g, mn, mx, n, h"""))
def q_prof_kde(spark, sf):
    return float32(PR.kde(_slim_train(spark, sf), "Age", "Transported", grid=64), ["x", "density"])


@register("agg_crosstab", with_views(
    f"SELECT coalesce(HomePlanet, 'Missing') AS \"row\", CAST(Transported AS VARCHAR) AS col, count(*) AS n FROM {TRAIN} GROUP BY 1, 2"))
def q_agg_crosstab(spark, sf):
    return ST.crosstab(_slim_train(spark, sf), "HomePlanet", "Transported")


@register("agg_crosstab_norm", with_views(
    f"SELECT coalesce(CAST(CryoSleep AS VARCHAR), 'Missing') AS \"row\", CAST(Transported AS VARCHAR) AS col, count(*) AS n, "
    f"CAST(count(*) / sum(count(*)) OVER (PARTITION BY coalesce(CAST(CryoSleep AS VARCHAR), 'Missing')) AS FLOAT) AS share "
    f"FROM {TRAIN} GROUP BY 1, 2"))
def q_agg_crosstab_norm(spark, sf):
    return float32(ST.crosstab(_slim_train(spark, sf), "CryoSleep", "Transported", normalize=True), ["share"])


CHI_COLS = ["HomePlanet", "Destination", "CryoSleep", "VIP"]


def _chi_sql() -> str:
    parts = []
    for c in CHI_COLS:
        parts.append(f"""SELECT '{c}' AS "column", CAST(sum(pow(abs(o - e) - CASE WHEN dof = 1 THEN least(0.5, abs(o - e)) ELSE 0 END, 2) / e) AS FLOAT) AS chi2,
          CAST(max(dof) AS BIGINT) AS dof FROM (
          SELECT coalesce(o, 0) AS o, rt * ct / tot AS e, dof FROM (
            SELECT v, y, o, sum(coalesce(o, 0)) OVER (PARTITION BY v) AS rt, sum(coalesce(o, 0)) OVER (PARTITION BY y) AS ct,
              sum(coalesce(o, 0)) OVER () AS tot,
              ((SELECT count(DISTINCT coalesce(CAST({c} AS VARCHAR), 'Missing')) FROM {TRAIN}) - 1) *
              ((SELECT count(DISTINCT Transported) FROM {TRAIN}) - 1) AS dof
            FROM (SELECT vv.v, yy.y, cnt.o FROM (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'Missing') AS v FROM {TRAIN}) vv
              CROSS JOIN (SELECT DISTINCT CAST(Transported AS VARCHAR) AS y FROM {TRAIN}) yy
              LEFT JOIN (SELECT coalesce(CAST({c} AS VARCHAR), 'Missing') AS v, CAST(Transported AS VARCHAR) AS y, CAST(count(*) AS DOUBLE) AS o
                FROM {TRAIN} GROUP BY 1, 2) cnt ON vv.v = cnt.v AND yy.y = cnt.y)))""")
    return " UNION ALL ".join(parts)


@register("stat_chi2", with_views(_chi_sql()))
def q_stat_chi2(spark, sf):
    return float32(ST.chi_square(_slim_train(spark, sf), CHI_COLS, "Transported", with_p=False), ["chi2"])


@register("stat_chi2_pvalue")
def q_stat_chi2_p(spark, sf):
    return ST.chi_square(_slim_train(spark, sf), CHI_COLS, "Transported", with_p=True)


CORR_COLS = ["Age", *SPEND, "CryoSleep_int", "VIP_int"]
_CORR_SRC = (f"(SELECT *, CAST(CryoSleep AS DOUBLE) AS CryoSleep_int, CAST(VIP AS DOUBLE) AS VIP_int, "
             f"CAST(Transported AS DOUBLE) AS y FROM {TRAIN})")


@register("stat_corr_target", with_views(
    "SELECT \"column\", CAST(r AS FLOAT) AS r FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", corr({c}, y) AS r FROM {_CORR_SRC}" for c in CORR_COLS)
    + ") ORDER BY abs(r) DESC NULLS LAST, \"column\" LIMIT 6"))
def q_stat_corr_target(spark, sf):
    d = _train(spark, sf).withColumns({"CryoSleep_int": F.col("CryoSleep").cast("double"), "VIP_int": F.col("VIP").cast("double")})
    return float32(ST.corr_with(d, CORR_COLS, "Transported", top=6), ["r"])


MAT_COLS = [*SPEND, "Age"]


@register("stat_corr_matrix", with_views(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, CAST(corr({a}, {b}) AS FLOAT) AS r FROM manifest"
    for i, a in enumerate(MAT_COLS) for j, b in enumerate(MAT_COLS) if j <= i)))
def q_stat_corr_matrix(spark, sf):
    return float32(ST.corr_matrix(_m(spark, sf), MAT_COLS), ["r"])


# ---- 2.5 group transforms and ordered windows ------------------------------------------------------
@register("win_size", with_views(
    "SELECT d.PassengerId, CASE WHEN d.GroupId IS NOT NULL THEN CAST(g.n AS DOUBLE) END AS GroupSize, "
    "CASE WHEN d.Surname IS NOT NULL THEN CAST(f.n AS DOUBLE) ELSE 1.0 END AS FamilySize FROM d0 d "
    "LEFT JOIN (SELECT GroupId, count(*) AS n FROM d0 WHERE GroupId IS NOT NULL GROUP BY GroupId) g ON d.GroupId = g.GroupId "
    "LEFT JOIN (SELECT Surname, count(*) AS n FROM d0 WHERE Surname IS NOT NULL GROUP BY Surname) f ON d.Surname = f.Surname", DECOMPOSE))
def q_win_size(spark, sf):
    d = FE.group_size(_d0(spark, sf), "GroupId", "GroupSize")
    d = FE.group_size(d, "Surname", "FamilySize", null_value=1.0)
    return d.select("PassengerId", "GroupSize", "FamilySize")


@register("win_group_stats", with_views(
    "SELECT d.PassengerId, CAST(s.am AS FLOAT) AS FamilyAgeMean, s.rm AS FamilyRoomMax FROM d0 d LEFT JOIN "
    "(SELECT Surname, avg(Age) AS am, max(RoomService) AS rm FROM d0 GROUP BY Surname) s ON d.Surname IS NOT DISTINCT FROM s.Surname",
    DECOMPOSE))
def q_win_group_stats(spark, sf):
    d = FE.group_aggregates(_d0(spark, sf), "Surname", {"FamilyAgeMean": ("mean", "Age"), "FamilyRoomMax": ("max", "RoomService")})
    return float32(d.select("PassengerId", "FamilyAgeMean", "FamilyRoomMax"), ["FamilyAgeMean"])


@register("win_cumsum", with_views(
    "SELECT model, p, n, pos, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos FROM (SELECT model, p, count(*) AS n, "
    "sum(y) AS pos FROM long_scores GROUP BY model, p) WINDOW w AS (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    scores=True))
def q_win_cumsum(spark, sf):
    c = long_scores(spark, sf).groupBy("model", "p").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("pos"))
    return WN.prefix_sums(c, ["model"], ["p"], {"cum_n": "n", "cum_pos": "pos"})


_SKEY = "((CAST(string_split(PassengerId, '_')[2] AS BIGINT) * 7919 + 2026) % 1000003)"


@register("win_rank_sample", with_views(f"SELECT PassengerId, Age FROM manifest ORDER BY {_SKEY}, PassengerId LIMIT 200"))
def q_win_rank_sample(spark, sf):
    key = (C.part("PassengerId", "_", 1).cast("long") * 7919 + 2026) % 1000003
    return WN.sample_n(_slim(spark, sf), 200, key, tie="PassengerId").select("PassengerId", "Age")


# ---- 2.6 joins ------------------------------------------------------------------------------------
@register("join_lookup", with_views(
    "SELECT m.PassengerId, coalesce(s.mode, 'Unknown') AS DestinationHome FROM manifest m LEFT JOIN ("
    "SELECT Destination, v AS mode FROM (SELECT Destination, HomePlanet AS v, row_number() OVER (PARTITION BY Destination "
    "ORDER BY count(*) DESC, HomePlanet) AS rn FROM manifest WHERE HomePlanet IS NOT NULL GROUP BY Destination, HomePlanet) WHERE rn = 1"
    ") s ON m.Destination IS NOT DISTINCT FROM s.Destination"))
def q_join_lookup(spark, sf):
    m = _slim(spark, sf)
    st = IM.mode_stats(m, "HomePlanet", ["Destination"]).withColumnRenamed("mode", "__stat_DestinationHome")
    out = IM.fill_from_stats(m.withColumn("DestinationHome", F.lit(None).cast("string")), st, ["Destination"], ["DestinationHome"])
    return out.select("PassengerId", F.coalesce("DestinationHome", F.lit("Unknown")).alias("DestinationHome"))


@register("join_cross_theta", with_views("""
SELECT w1 AS w_p_a, w2 AS w_p_b, w3 AS w_p_c, CAST(avg(w1 * p_a + w2 * p_b + w3 * p_c) AS FLOAT) AS mean,
  CAST(avg(pow(w1 * p_a + w2 * p_b + w3 * p_c - CAST(Transported AS INTEGER), 2)) AS FLOAT) AS squared_error
FROM scores, (SELECT CAST(i AS DOUBLE) / 100 AS w1, CAST(j AS DOUBLE) / 100 AS w2, CAST(100 - i - j AS DOUBLE) / 100 AS w3
  FROM range(1, 99) a(i), range(1, 99) b(j) WHERE i + j <= 99) WHERE split = 'oof' GROUP BY ALL""", scores=True))
def q_join_cross_theta(spark, sf):
    s = scores(spark, sf).where("split = 'oof'").withColumn("y", F.col("Transported").cast("int"))
    return float32(ENS.grid_errors(s, ["p_a", "p_b", "p_c"]), ["mean", "squared_error"])


@register("join_align", with_views(
    "SELECT s.id, s.model, s.p, m.HomePlanet FROM long_scores s JOIN manifest m ON s.id = m.PassengerId", scores=True))
def q_join_align(spark, sf):
    s = long_scores(spark, sf)
    m = _slim(spark, sf).select(F.col("PassengerId").alias("id"), "HomePlanet")
    return s.join(m, "id").select("id", "model", "p", "HomePlanet")


# ---- 2.7 sets, sort, top-k --------------------------------------------------------------------------
@register("set_union", with_views(
    "SELECT PassengerId, Transported, is_train FROM manifest WHERE is_train UNION ALL "
    "SELECT PassengerId, NULL, is_train FROM manifest WHERE NOT is_train"))
def q_set_union(spark, sf):
    m = _slim(spark, sf)
    train = m.where("is_train").select("PassengerId", "Transported", "is_train")
    test = m.where("NOT is_train").select("PassengerId", "is_train")
    return train.unionByName(test, allowMissingColumns=True)


@register("set_hstack", with_views(
    "SELECT id, y, max(CASE WHEN model = 'a' THEN p END) AS a, max(CASE WHEN model = 'b' THEN p END) AS b, "
    "max(CASE WHEN model = 'c' THEN p END) AS c, count(*) = 3 AND count(DISTINCT model) = 3 AS whole FROM long_scores GROUP BY id, y", scores=True))
def q_set_hstack(spark, sf):
    return ENS.stack_columns(long_scores(spark, sf), ["id", "y"], "model", "p", ["a", "b", "c"])


@register("sort_by", with_views(
    "SELECT Destination, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, Destination) - 1 AS position "
    "FROM manifest WHERE Destination IS NOT NULL GROUP BY Destination"))
def q_sort_by(spark, sf):
    vc = PR.value_counts(_slim(spark, sf), "Destination")
    return WN.row_ranks(vc, [], [F.col("count").desc(), F.col("Destination")], out="position")


@register("topk", with_views("SELECT PassengerId, RoomService FROM manifest WHERE RoomService IS NOT NULL "
                             "ORDER BY RoomService DESC, PassengerId LIMIT 5"))
def q_topk(spark, sf):
    m = _m(spark, sf).where(F.col("RoomService").isNotNull())
    return m.orderBy(F.col("RoomService").desc(), "PassengerId").limit(5).select("PassengerId", "RoomService")


# ---- 2.8 encoders and splits -------------------------------------------------------------------------
@register("enc_category", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", v AS category, CAST(row_number() OVER (ORDER BY count(*) DESC, v) - 1 AS DOUBLE) AS \"index\" "
    f"FROM (SELECT {c} AS v FROM d0 WHERE is_train AND {c} IS NOT NULL) GROUP BY v" for c in ["Destination", "CabinDeck"]), DECOMPOSE))
def q_enc_category(spark, sf):
    """The index that training fits, and the same as a Spark table for columns too wide for it."""
    d = _d0(spark, sf).where("is_train").select("Destination", "CabinDeck")
    fitted = EN.index_table(EN.index_categories(d.select("Destination").dropna(), d.limit(0), ["Destination"])[2], ["Destination"])
    return fitted.unionByName(EN.category_index_table(d, "CabinDeck"))


TE_COLS = ["HomePlanet", "CryoSleep", "Cabin", "Destination", "VIP", "Name", "GroupId", "CabinDeck", "CabinSide", "FirstName", "Surname", "CabinKnown"]
TE_SEEDS = (42, 7)


def _te_sql() -> str:
    """Two orders averaged for training rows; statistics of all of them for the others."""
    num = "CAST(string_split(PassengerId, '_')[2] AS BIGINT)"
    code = " + ".join(f"(coalesce(sum(y) OVER w{{c}}_{s}, 0) + prior) / (count(*) OVER w{{c}}_{s} + 1.0)" for s in TE_SEEDS)
    train = ", ".join(f"CAST(({code.format(c=c)}) / {len(TE_SEEDS)} AS FLOAT) AS {c}_te" for c in TE_COLS)
    windows = ", ".join(f"w{c}_{s} AS (PARTITION BY {c} ORDER BY ({num} * 7919 + {s}) % 1000003, PassengerId ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in TE_COLS for s in TE_SEEDS)
    joins = " ".join(f"LEFT JOIN (SELECT {c}, sum(y) AS sy, count(*) AS n FROM te_train GROUP BY {c}) s{c} ON o.{c} IS NOT DISTINCT FROM s{c}.{c}" for c in TE_COLS)
    rest = ", ".join(f"CAST((coalesce(s{c}.sy, 0) + prior) / (coalesce(s{c}.n, 0) + 1.0) AS FLOAT) AS {c}_te" for c in TE_COLS)
    return f"SELECT PassengerId, {train} FROM te_train WINDOW {windows} UNION ALL SELECT o.PassengerId, {rest} FROM (SELECT *, (SELECT max(prior) FROM te_train) AS prior FROM d0 WHERE NOT is_train) o {joins}"


@register("enc_string_cat", with_views(_te_sql(), DECOMPOSE, "te_train AS (SELECT *, CAST(Transported AS DOUBLE) AS y, avg(CAST(Transported AS DOUBLE)) OVER () AS prior FROM d0 WHERE is_train)"))
def q_enc_string_cat(spark, sf):
    """Twelve columns, training and scoring rows."""
    d = cut_lineage(P.decompose(_slim(spark, sf)).select("PassengerId", "Transported", "is_train", *TE_COLS), "encoded")
    orders = [(C.part("PassengerId", "_", 1).cast("long") * 7919 + s) % 1000003 for s in TE_SEEDS]
    tr, (te,) = EN.target_encode(d.where("is_train"), [d.where("NOT is_train")], TE_COLS, "Transported", "PassengerId", orders)
    return float32(tr.unionByName(te).select("PassengerId", *[c + "_te" for c in TE_COLS]))


@register("enc_onehot", with_views(" UNION ALL ".join(
    f"SELECT o.PassengerId AS id, '{c}' AS \"column\", CASE WHEN t.n < 2 THEN '__infrequent__' ELSE t.v END AS category "
    f"FROM (SELECT PassengerId, {c} AS v FROM manifest WHERE NOT is_train) o JOIN (SELECT {c} AS v, count(*) AS n FROM manifest "
    f"WHERE is_train GROUP BY {c}) t ON o.v = t.v" for c in ["Destination", "Cabin"])))
def q_enc_onehot(spark, sf):
    m = _slim(spark, sf)
    return EN.one_hot_long(m.where("is_train"), m.where("NOT is_train"), "PassengerId", ["Destination", "Cabin"], min_frequency=2)


@register("enc_scale", with_views(
    "SELECT PassengerId, " + ", ".join(
        f"CAST(({c} - (SELECT avg({c}) FROM manifest WHERE is_train)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 "
        f"ELSE stddev_pop({c}) END FROM manifest WHERE is_train) AS FLOAT) AS {c}" for c in ["Age", "RoomService"])
    + " FROM manifest WHERE NOT is_train"))
def q_enc_scale(spark, sf):
    m = _m(spark, sf).select("PassengerId", "Age", "RoomService", "is_train")
    _, te = EN.standardize(m.where("is_train"), m.where("NOT is_train"), ["Age", "RoomService"])
    return float32(te.select("PassengerId", "Age", "RoomService"))


def _arith_key(seed):
    return (C.part("id", "_", 1).cast("long") * 7919 + seed) % 1000003


def _key_for(seed):
    return (C.part("PassengerId", "_", 1).cast("long") * 7919 + seed) % 1000003


@register("split_strat", with_views(f"""
SELECT id, rk < ceil(n * 0.2) AS holdout FROM (
  SELECT PassengerId AS id, row_number() OVER (PARTITION BY Transported ORDER BY {_SKEY}, PassengerId) - 1 AS rk,
    count(*) OVER (PARTITION BY Transported) AS n FROM manifest WHERE is_train)"""))
def q_split_strat(spark, sf):
    return SP.stratified_holdout(_slim_train(spark, sf), "PassengerId", "Transported", 0.2, 2026, key=_key_for)


@register("split_kfold", with_views(" UNION ALL ".join(f"""
SELECT PassengerId AS id, {s} AS seed, CAST((row_number() OVER (PARTITION BY Transported ORDER BY
  ((CAST(string_split(PassengerId, '_')[2] AS BIGINT) * 7919 + {s}) % 1000003), PassengerId) - 1) % 5 AS INTEGER) AS fold
FROM manifest WHERE is_train""" for s in (2026, 42))))
def q_split_kfold(spark, sf):
    return SP.stratified_kfold(_slim_train(spark, sf), "PassengerId", "Transported", 5, (2026, 42), key=_key_for)

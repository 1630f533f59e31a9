"""Checked queries: decomposition, scalar/row operators, imputation,
features."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.features_sql import CAT, NUM, feature_ctes, impute_ctes
from checks.registry import float32, register
from checks.sqlgen import SPEND, as_float, level, with_views
from cohortkit.functions import columns as C
from cohortkit.operators import features as FE
from cohortkit.operators import impute as IM
from cohortkit.plans import prepare as P
from cohortkit.plans.views import manifest


def _m(spark, sf):
    return manifest(spark, sf)


def _slim(spark, sf):
    return manifest(spark, sf, spend=False)


# ---- flagship: the whole preparation plan --------------------------------------------------------
FEATURES_SQL = with_views(
    f"SELECT PassengerId, is_train, Transported, {as_float(NUM)}, {', '.join(CAT)} FROM feat", *feature_ctes())


@register("features", FEATURES_SQL)
def q_features(spark, sf):
    return float32(P.build_features(_m(spark, sf)), NUM)


# ---- 2.2 decomposition -------------------------------------------------------------------------------
@register("str_split_id", with_views("SELECT PassengerId, GroupId, GroupNumber, GroupMember FROM d0", *impute_ctes()[:1]))
def q_split_id(spark, sf):
    return P.decompose(_slim(spark, sf)).select("PassengerId", "GroupId", "GroupNumber", "GroupMember")


@register("str_split_path", with_views("SELECT PassengerId, Cabin, CabinDeck, CabinNum, CabinSide, CabinKnown FROM d0", *impute_ctes()[:1]))
def q_split_path(spark, sf):
    return P.decompose(_slim(spark, sf)).select("PassengerId", "Cabin", "CabinDeck", "CabinNum", "CabinSide", "CabinKnown")


@register("str_split_first", with_views("SELECT PassengerId, Name, FirstName, Surname FROM d0", *impute_ctes()[:1]))
def q_split_first(spark, sf):
    return P.decompose(_slim(spark, sf)).select("PassengerId", "Name", "FirstName", "Surname")


# ---- 2.4 imputation --------------------------------------------------------------------------------
@register("imp_mode", with_views(
    "SELECT PassengerId, HomePlanet FROM m1",
    level("m1", "manifest", ["Destination", "CryoSleep"], ["HomePlanet"])))
def q_imp_mode(spark, sf):
    """Composite key with NULLs as groups: fill HomePlanet by (Destination, CryoSleep) mode."""
    return IM.fill_mode(_slim(spark, sf), ["HomePlanet"], ["Destination", "CryoSleep"]).select("PassengerId", "HomePlanet")


@register("imp_median", with_views(
    "SELECT PassengerId, CAST(Age AS FLOAT) AS Age FROM m3",
    level("m1", "manifest", ["HomePlanet"], [], ["Age"]),
    level("m2", "m1", ["Destination"], [], ["Age"]),
    level("m3", "m2", [], [], ["Age"])))
def q_imp_median(spark, sf):
    df = IM.fill_median(_slim(spark, sf), ["Age"], [["HomePlanet"], ["Destination"]], global_fill=True)
    return float32(df.select("PassengerId", "Age"))


def _imputed(spark, sf):
    df = P.pre_counts(P.decompose(_m(spark, sf)))
    return P.impute(df)


IMP_COLS = ["HomePlanet", "Destination", "CabinDeck", "CabinSide", "CryoSleep", "VIP", "Age", "CabinNum", *SPEND, "TotalSpend"]


@register("imp_home", with_views("SELECT PassengerId, HomePlanet FROM l4", *impute_ctes()[:7]))
def q_imp_home(spark, sf):
    df = P.pre_counts(P.decompose(_m(spark, sf)))
    df = df.withColumn(P.RAW_DECK, F.col("CabinDeck")).withColumn(P.RAW_SIDE, F.col("CabinSide"))
    df = IM.fill_from_lookup(df, "HomePlanet", P.RAW_DECK, P.DECK_HOME)
    for keys in (["GroupId"], ["Surname"], [P.RAW_DECK], [P.RAW_SIDE]):
        df = IM.fill_mode(df, ["HomePlanet"], keys)
    return df.select("PassengerId", "HomePlanet")


@register("imp_cats", with_views("SELECT PassengerId, Destination, CabinDeck, CabinSide FROM imputed", *impute_ctes()))
def q_imp_cats(spark, sf):
    return _imputed(spark, sf).select("PassengerId", "Destination", "CabinDeck", "CabinSide")


@register("imp_rule_bool", with_views("SELECT PassengerId, CryoSleep FROM d4", *impute_ctes()[:3]))
def q_imp_rule_bool(spark, sf):
    df = P.pre_counts(P.decompose(_m(spark, sf)))
    return IM.infer_flag(df, "CryoSleep", SPEND, total_col="TotalSpendRaw").select("PassengerId", "CryoSleep")


@register("imp_spend", with_views(f"SELECT PassengerId, {as_float(SPEND)} FROM imputed", *impute_ctes()))
def q_imp_spend(spark, sf):
    return float32(_imputed(spark, sf).select("PassengerId", *SPEND))


@register("imp_fix", with_views("SELECT PassengerId, CryoSleep, CAST(TotalSpend AS FLOAT) AS TotalSpend FROM imputed", *impute_ctes()))
def q_imp_fix(spark, sf):
    return float32(_imputed(spark, sf).select("PassengerId", "CryoSleep", "TotalSpend"))


@register("imp_vip", with_views("SELECT PassengerId, VIP FROM imputed", *impute_ctes()))
def q_imp_vip(spark, sf):
    return _imputed(spark, sf).select("PassengerId", "VIP")


@register("imp_num", with_views("SELECT PassengerId, CAST(Age AS FLOAT) AS Age, CAST(CabinNum AS FLOAT) AS CabinNum FROM imputed", *impute_ctes()))
def q_imp_num(spark, sf):
    return float32(_imputed(spark, sf).select("PassengerId", "Age", "CabinNum"))

"""Preparation plan for a passenger-style manifest: decompose packed
columns, impute with sequential group-aware cascades, engineer the feature
contract (35 numeric + 12 categorical columns).

Training and scoring rows are processed together (statistics are fitted on
their union, as in the original workflow); ``is_train`` and the label travel
along as columns, rows are never matched by position.

Batched cascade.  Imputing column by column would take 23 mode levels and 30
median levels.  A level's statistic depends only on its own column and its
keys, so all columns that use the same key at the same point of the sequence
share one aggregation.  Levels of different columns whose keys don't change any
more run in one step.  The steps below are equivalent to the column-by-column
sequence:

 1 GroupId    modes Home Dest Deck Side VIP Cryo, medians Age CabinNum
 2 Surname    same
 3 raw Deck   mode Home            (the Deck value before its own imputation)
 4 raw Side   mode Home
 5 Home       modes Dest Deck Side VIP Cryo
 6 Home,Dest  modes Deck Side, median Age
 7 Dest       mode Cryo;  Home median Age;  Deck,Side median CabinNum
   then Cryo, VIP -> False, and spend 0 where asleep
 8 Deck       median CabinNum;  (Home,Dest,Cryo) medians of spend
 9 global     medians Age CabinNum;  (Home,Cryo) medians of spend
10 Dest,Cryo  medians of spend
11 global     medians of spend

Destination by (Home, Destination) is left out: its own key is null
whenever the value is, so that level can never fill anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions import columns as C
from cohortkit.operators import features as FE
from cohortkit.operators.impute import Level, cascade, fill_from_lookup, fill_from_stats, infer_flag, repair_flag, update_where
from cohortkit.plans.views import ID_COL, LABEL_COL, SPEND_COLS, TRAIN_FLAG
from cohortkit.runtime import cut_lineage, outliving, scratch_tables

# Cabin deck -> home lookup used before the home cascade.
DECK_HOME = {"A": "Europa", "B": "Europa", "C": "Europa", "T": "Europa", "G": "Earth"}

# The feature contract.
CAT_BASE = ["HomePlanet", "CryoSleep", "Destination", "VIP", "CabinDeck", "CabinSide", "Surname"]
CAT_FEATURES = [
    "HomePlanet", "CryoSleep", "Destination", "VIP", "CabinDeck", "CabinSide", "DeckSide",
    "HomeDestination", "HomeDeck", "DestinationDeck", "CryoHome", "Surname",
]
NUM_FEATURES = [
    "Age", "RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck", "GroupNumber", "GroupMember",
    "CabinNum", "CabinKnown", "SpendMissingCount", "SpendKnownCount", "TotalSpend", "FoodSpend",
    "LuxurySpend", "SpendMean", "SpendStd", "SpendMax", "SpendMin", "ServicesUsed", "ZeroSpend",
    "GroupSize", "IsAlone", "FamilySize", "CabinGroupSize", "SpendPerGroup", "SpendPerFamily",
    "CabinNumPerGroup", "GroupAgeMean", "GroupSpendMean", "GroupSpendMax", "FamilyAgeMean",
    "FamilySpendMean", "AgeMissing", "CabinNumMissing",
]
INTERACTIONS = {
    "DeckSide": ("CabinDeck", "CabinSide"),
    "HomeDestination": ("HomePlanet", "Destination"),
    "HomeDeck": ("HomePlanet", "CabinDeck"),
    "DestinationDeck": ("Destination", "CabinDeck"),
    "CryoHome": ("CryoSleep", "HomePlanet"),
}

RAW_DECK, RAW_SIDE = "__raw_deck", "__raw_side"


def decompose(df: DataFrame) -> DataFrame:
    """Id -> GroupId/GroupNumber/GroupMember; Cabin -> Deck/Num/Side/Known;
    Name -> FirstName/Surname."""
    df = FE.split_packed(df, ID_COL, "_", [("GroupId", 0, "string"), ("GroupNumber", 0, "double"), ("GroupMember", 1, "double")])
    df = FE.split_packed(df, "Cabin", "/", [("CabinDeck", 0, "string"), ("CabinNum", 1, "double"), ("CabinSide", 2, "string")],
                         known_flag="CabinKnown")
    return FE.split_first(df, "Name", "FirstName", "Surname")


def pre_counts(df: DataFrame) -> DataFrame:
    """Indicators taken before any value is filled."""
    return df.withColumns({
        "SpendMissingCount": C.null_count(SPEND_COLS),
        "SpendKnownCount": C.known_count(SPEND_COLS),
        "TotalSpendRaw": C.row_sum(SPEND_COLS, min_count=1),
        "AgeMissing": F.col("Age").isNull().cast("int"),
        "CabinNumMissing": F.col("CabinNum").isNull().cast("int"),
    })


def impute(df: DataFrame, cut_every: int = 2) -> DataFrame:
    """The batched cascade described in the module docstring."""
    cats_by_id = ["HomePlanet", "Destination", "CabinDeck", "CabinSide", "VIP", "CryoSleep"]
    df = df.withColumns({RAW_DECK: F.col("CabinDeck"), RAW_SIDE: F.col("CabinSide")})
    df = fill_from_lookup(df, "HomePlanet", RAW_DECK, DECK_HOME)
    df = infer_flag(df, "CryoSleep", SPEND_COLS, total_col="TotalSpendRaw")

    def asleep(rows: DataFrame) -> DataFrame:
        """Unknown flags are off; asleep passengers spend nothing."""
        rows = rows.withColumns({"CryoSleep": F.coalesce("CryoSleep", F.lit(False)), "VIP": F.coalesce("VIP", F.lit(False))})
        return rows.withColumns({c: F.when(F.col("CryoSleep"), F.coalesce(F.col(c), F.lit(0.0))).otherwise(F.col(c)) for c in SPEND_COLS})

    df = cascade(df, [
        Level(["GroupId"], modes=cats_by_id, medians=["Age", "CabinNum"]),
        Level(["Surname"], modes=cats_by_id, medians=["Age", "CabinNum"]),
        Level([RAW_DECK], modes=["HomePlanet"]),
        Level([RAW_SIDE], modes=["HomePlanet"]),
        Level(["HomePlanet"], modes=["Destination", "CabinDeck", "CabinSide", "VIP", "CryoSleep"]),
        Level(["HomePlanet", "Destination"], modes=["CabinDeck", "CabinSide"], medians=["Age"]),
        [Level(["Destination"], modes=["CryoSleep"]), Level(["HomePlanet"], medians=["Age"]), Level(["CabinDeck", "CabinSide"], medians=["CabinNum"])],
        asleep,
        [Level(["CabinDeck"], medians=["CabinNum"]), Level(["HomePlanet", "Destination", "CryoSleep"], medians=SPEND_COLS)],
        [Level([], medians=["Age", "CabinNum"]), Level(["HomePlanet", "CryoSleep"], medians=SPEND_COLS)],
        Level(["Destination", "CryoSleep"], medians=SPEND_COLS),
        Level([], medians=SPEND_COLS),
    ], cut_every=cut_every)
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in SPEND_COLS})
    df = df.withColumn("TotalSpend", C.row_sum(SPEND_COLS))
    df = repair_flag(df, "CryoSleep", "TotalSpend")
    return df.drop(RAW_DECK, RAW_SIDE)


def _mean(c: str) -> Column:
    """Mean from an exact sum of six decimals: the same in whatever order rows
    are added."""
    return F.sum(F.col(c).cast("decimal(28,6)")).cast("double") / F.count(c)


def key_features(df: DataFrame, null_family: str = "self", cut: bool = False) -> DataFrame:
    """Group, family and cabin sizes and means, attached per row.  One
    aggregation per key.  ``null_family='self'``: a passenger without a
    surname is a family of one; ``'unknown'``: all of them form one
    'Unknown' family.  ``cut`` writes the family and cabin tables first: if they turn out
    small, their joins don't shuffle the rows."""
    if null_family == "unknown":
        df = df.withColumn("Surname", F.coalesce(F.col("Surname"), F.lit("Unknown")))
    by_group = df.groupBy("GroupId").agg(
        F.count(F.lit(1)).cast("double").alias("__stat_GroupSize"),
        _mean("Age").alias("__stat_GroupAgeMean"),
        _mean("TotalSpend").alias("__stat_GroupSpendMean"),
        F.max("TotalSpend").cast("double").alias("__stat_GroupSpendMax"),
    )
    by_family = df.groupBy("Surname").agg(
        F.count(F.lit(1)).cast("double").alias("__stat_FamilySize"),
        _mean("Age").alias("__stat_FamilyAgeMean"),
        _mean("TotalSpend").alias("__stat_FamilySpendMean"),
    )
    by_cabin = df.where(F.col("Cabin").isNotNull()).groupBy("Cabin").agg(
        F.count(F.lit(1)).cast("double").alias("__stat_CabinGroupSize"))
    if cut:
        by_family, by_cabin = cut_lineage(by_family, "families"), cut_lineage(by_cabin, "cabins")
    names = ["GroupSize", "GroupAgeMean", "GroupSpendMean", "GroupSpendMax", "FamilySize", "FamilyAgeMean",
             "FamilySpendMean", "CabinGroupSize"]
    df = df.withColumns({n: F.lit(None).cast("double") for n in names})
    df = fill_from_stats(df, by_group, ["GroupId"], names[:4])
    df = fill_from_stats(df, by_family, ["Surname"], names[4:7])
    df = fill_from_stats(df, by_cabin, ["Cabin"], ["CabinGroupSize"])
    return df.withColumns({
        # a NULL group id has no size; the family and cabin of an unknown are the row itself
        "GroupSize": F.when(F.col("GroupId").isNotNull(), F.col("GroupSize")),
        "FamilySize": F.when(F.col("Surname").isNotNull(), F.col("FamilySize")).otherwise(F.lit(1.0)),
        "CabinGroupSize": F.coalesce(F.col("CabinGroupSize"), F.lit(1.0)),
    })


def engineer(df: DataFrame, null_family: str = "self", cut: bool = False) -> DataFrame:
    df = key_features(df, null_family, cut)
    df = FE.row_features(df, SPEND_COLS)
    df = df.withColumns({
        "IsAlone": C.is_zero(F.col("GroupSize") - 1),
        "FoodSpend": F.col("FoodCourt") + F.col("ShoppingMall"),
        "LuxurySpend": F.col("RoomService") + F.col("Spa") + F.col("VRDeck"),
        "SpendPerGroup": C.safe_ratio("TotalSpend", C.clip_lower("GroupSize", 1)),
        "SpendPerFamily": C.safe_ratio("TotalSpend", C.clip_lower("FamilySize", 1)),
        "CabinNumPerGroup": C.safe_ratio("CabinNum", C.clip_lower("GroupNumber", 1)),
    })
    df = FE.stringify(df, CAT_BASE)
    return FE.cross(df, INTERACTIONS)


def build_features(raw: DataFrame, null_family: str = "self", cut_every: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """Manifest -> ``(PassengerId, is_train, Transported, 35 numeric, 12 categorical)``."""
    df = pre_counts(decompose(raw))
    if cut_every:
        with scratch_tables():
            df = impute(df, cut_every=cut_every)
            with outliving():
                imputed = cut_lineage(df, "imputed")
        with scratch_tables():
            df = engineer(imputed, null_family, cut=True)
            # written once: the null count, the medians and the final rows all
            # read it instead of replaying the group-feature joins
            with outliving():
                df = cut_lineage(df.select(ID_COL, TRAIN_FLAG, LABEL_COL, *[c for c in keep if c not in NUM_FEATURES + CAT_FEATURES],
                                           *NUM_FEATURES, *CAT_FEATURES), "engineered", instead=imputed)
        gaps = FE.with_gaps(df, NUM_FEATURES)
        df = FE.clean_numeric(df, gaps) if gaps else df
    else:
        df = FE.clean_numeric(engineer(impute(df, cut_every=0), null_family), NUM_FEATURES)
    extra = [c for c in keep if c not in NUM_FEATURES + CAT_FEATURES]
    return df.select(ID_COL, TRAIN_FLAG, LABEL_COL, *extra, *NUM_FEATURES, *CAT_FEATURES)

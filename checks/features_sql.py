"""Oracle SQL for the preparation plan (decompose -> impute -> engineer ->
clean), as a chain of CTEs ending in ``feat``."""

from __future__ import annotations

from checks.sqlgen import SPEND, level

NUM = [
    "Age", "RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck", "GroupNumber", "GroupMember",
    "CabinNum", "CabinKnown", "SpendMissingCount", "SpendKnownCount", "TotalSpend", "FoodSpend",
    "LuxurySpend", "SpendMean", "SpendStd", "SpendMax", "SpendMin", "ServicesUsed", "ZeroSpend",
    "GroupSize", "IsAlone", "FamilySize", "CabinGroupSize", "SpendPerGroup", "SpendPerFamily",
    "CabinNumPerGroup", "GroupAgeMean", "GroupSpendMean", "GroupSpendMax", "FamilyAgeMean",
    "FamilySpendMean", "AgeMissing", "CabinNumMissing",
]
CAT = [
    "HomePlanet", "CryoSleep", "Destination", "VIP", "CabinDeck", "CabinSide", "DeckSide",
    "HomeDestination", "HomeDeck", "DestinationDeck", "CryoHome", "Surname",
]
CATS_BY_ID = ["HomePlanet", "Destination", "CabinDeck", "CabinSide", "VIP", "CryoSleep"]


def rsum(cols=SPEND, fill=True) -> str:
    return "(" + " + ".join(f"coalesce({c}, 0.0)" if fill else c for c in cols) + ")"


def known(cols=SPEND) -> str:
    return "(" + " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols) + ")"


def missing(cols=SPEND) -> str:
    return "(" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols) + ")"


DECOMPOSE = f"""
d0 AS (SELECT *,
  string_split(PassengerId, '_')[1] AS GroupId,
  TRY_CAST(string_split(PassengerId, '_')[1] AS DOUBLE) AS GroupNumber,
  TRY_CAST(string_split(PassengerId, '_')[2] AS DOUBLE) AS GroupMember,
  string_split(Cabin, '/')[1] AS CabinDeck,
  TRY_CAST(string_split(Cabin, '/')[2] AS DOUBLE) AS CabinNum,
  string_split(Cabin, '/')[3] AS CabinSide,
  CAST(Cabin IS NOT NULL AS INTEGER) AS CabinKnown,
  CASE WHEN Name IS NULL THEN 'Unknown' WHEN strpos(Name, ' ') > 0 THEN substr(Name, 1, strpos(Name, ' ') - 1) ELSE Name END AS FirstName,
  CASE WHEN Name IS NULL THEN NULL WHEN strpos(Name, ' ') > 0 THEN substr(Name, strpos(Name, ' ') + 1) ELSE 'Unknown' END AS Surname
FROM manifest)"""

PRECOUNTS = f"""
d1 AS (SELECT *,
  {missing()} AS SpendMissingCount,
  {known()} AS SpendKnownCount,
  CASE WHEN {known()} >= 1 THEN {rsum()} END AS TotalSpendRaw,
  CAST(Age IS NULL AS INTEGER) AS AgeMissing,
  CAST(CabinNum IS NULL AS INTEGER) AS CabinNumMissing
FROM d0)"""

RULES = f"""
d2 AS (SELECT * REPLACE (coalesce(HomePlanet, CASE CabinDeck WHEN 'A' THEN 'Europa' WHEN 'B' THEN 'Europa'
    WHEN 'C' THEN 'Europa' WHEN 'T' THEN 'Europa' WHEN 'G' THEN 'Earth' END) AS HomePlanet),
  CabinDeck AS __raw_deck, CabinSide AS __raw_side FROM d1),
d3 AS (SELECT * REPLACE (CASE WHEN coalesce(TotalSpendRaw, 0.0) > 0 AND CryoSleep IS NULL THEN false ELSE CryoSleep END AS CryoSleep) FROM d2),
d4 AS (SELECT * REPLACE (CASE WHEN {rsum()} = 0 AND CryoSleep IS NULL THEN true ELSE CryoSleep END AS CryoSleep) FROM d3)"""


def impute_ctes() -> list[str]:
    return [
        DECOMPOSE, PRECOUNTS, RULES,
        level("l1", "d4", ["GroupId"], CATS_BY_ID, ["Age", "CabinNum"]),
        level("l2", "l1", ["Surname"], CATS_BY_ID, ["Age", "CabinNum"]),
        level("l3", "l2", ["__raw_deck"], ["HomePlanet"]),
        level("l4", "l3", ["__raw_side"], ["HomePlanet"]),
        level("l5", "l4", ["HomePlanet"], ["Destination", "CabinDeck", "CabinSide", "VIP", "CryoSleep"]),
        level("l6", "l5", ["HomePlanet", "Destination"], ["CabinDeck", "CabinSide"], ["Age"]),
        level("l7", "l6", ["Destination"], ["CryoSleep"]),
        "c1 AS (SELECT * REPLACE (coalesce(CryoSleep, false) AS CryoSleep, coalesce(VIP, false) AS VIP) FROM l7)",
        "c2 AS (SELECT * REPLACE (" + ", ".join(f"CASE WHEN CryoSleep THEN coalesce({c}, 0.0) ELSE {c} END AS {c}" for c in SPEND) + ") FROM c1)",
        level("l8", "c2", ["HomePlanet"], [], ["Age"]),
        level("l9", "l8", ["CabinDeck", "CabinSide"], [], ["CabinNum"]),
        level("l10", "l9", ["CabinDeck"], [], ["CabinNum"]),
        level("l11", "l10", [], [], ["Age", "CabinNum"]),
        level("l12", "l11", ["HomePlanet", "Destination", "CryoSleep"], [], SPEND),
        level("l13", "l12", ["HomePlanet", "CryoSleep"], [], SPEND),
        level("l14", "l13", ["Destination", "CryoSleep"], [], SPEND),
        level("l15", "l14", [], [], SPEND),
        "c3 AS (SELECT * REPLACE (" + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in SPEND) + ") FROM l15)",
        f"c4 AS (SELECT *, {rsum()} AS TotalSpend FROM c3)",
        "imputed AS MATERIALIZED (SELECT * EXCLUDE (__raw_deck, __raw_side) REPLACE "
        "(CASE WHEN TotalSpend > 0 AND CryoSleep = true THEN false ELSE CryoSleep END AS CryoSleep) FROM c4)",
    ]


def _clip(c: str) -> str:
    return f"CASE WHEN {c} < 1 THEN 1.0 ELSE CAST({c} AS DOUBLE) END"


def engineer_ctes() -> list[str]:
    mean = f"(CASE WHEN {known()} > 0 THEN {rsum()} / {known()} END)"
    ss = " + ".join(f"coalesce(({c} - {mean}) * ({c} - {mean}), 0.0)" for c in SPEND)
    std = f"coalesce(CASE WHEN {known()} > 1 THEN sqrt(({ss}) / ({known()} - 1)) END, 0.0)"
    return [
        "kg AS MATERIALIZED (SELECT GroupId, CAST(count(*) AS DOUBLE) AS gs, avg(Age) AS gam, avg(TotalSpend) AS gsm, "
        "CAST(max(TotalSpend) AS DOUBLE) AS gsx FROM imputed GROUP BY GroupId)",
        "kf AS MATERIALIZED (SELECT Surname, CAST(count(*) AS DOUBLE) AS fs, avg(Age) AS fam, avg(TotalSpend) AS fsm "
        "FROM imputed GROUP BY Surname)",
        "kc AS MATERIALIZED (SELECT Cabin, CAST(count(*) AS DOUBLE) AS cs FROM imputed WHERE Cabin IS NOT NULL GROUP BY Cabin)",
        f"""e1 AS (SELECT i.*,
  CASE WHEN i.GroupId IS NOT NULL THEN kg.gs END AS GroupSize, kg.gam AS GroupAgeMean, kg.gsm AS GroupSpendMean, kg.gsx AS GroupSpendMax,
  CASE WHEN i.Surname IS NOT NULL THEN kf.fs ELSE 1.0 END AS FamilySize, kf.fam AS FamilyAgeMean, kf.fsm AS FamilySpendMean,
  coalesce(kc.cs, 1.0) AS CabinGroupSize
FROM imputed i
LEFT JOIN kg ON i.GroupId IS NOT DISTINCT FROM kg.GroupId
LEFT JOIN kf ON i.Surname IS NOT DISTINCT FROM kf.Surname
LEFT JOIN kc ON i.Cabin IS NOT DISTINCT FROM kc.Cabin)""",
        f"""e2 AS (SELECT *,
  {mean} AS SpendMean, {std} AS SpendStd,
  greatest({", ".join(SPEND)}) AS SpendMax, least({", ".join(SPEND)}) AS SpendMin,
  ({" + ".join(f"CAST(coalesce({c} > 0, false) AS INTEGER)" for c in SPEND)}) AS ServicesUsed,
  CAST(coalesce({rsum()} = 0, false) AS INTEGER) AS ZeroSpend,
  CAST(coalesce(GroupSize - 1 = 0, false) AS INTEGER) AS IsAlone,
  FoodCourt + ShoppingMall AS FoodSpend,
  RoomService + Spa + VRDeck AS LuxurySpend,
  TotalSpend / {_clip("GroupSize")} AS SpendPerGroup,
  TotalSpend / {_clip("FamilySize")} AS SpendPerFamily,
  CabinNum / {_clip("GroupNumber")} AS CabinNumPerGroup
FROM e1)""",
        """e3 AS (SELECT * REPLACE (
  coalesce(HomePlanet, 'Unknown') AS HomePlanet,
  coalesce(CASE WHEN CryoSleep THEN 'True' WHEN NOT CryoSleep THEN 'False' END, 'Unknown') AS CryoSleep,
  coalesce(Destination, 'Unknown') AS Destination,
  coalesce(CASE WHEN VIP THEN 'True' WHEN NOT VIP THEN 'False' END, 'Unknown') AS VIP,
  coalesce(CabinDeck, 'Unknown') AS CabinDeck,
  coalesce(CabinSide, 'Unknown') AS CabinSide,
  coalesce(Surname, 'Unknown') AS Surname) FROM e2)""",
        """e4 AS (SELECT *,
  CabinDeck || '_' || CabinSide AS DeckSide,
  HomePlanet || '_' || Destination AS HomeDestination,
  HomePlanet || '_' || CabinDeck AS HomeDeck,
  Destination || '_' || CabinDeck AS DestinationDeck,
  CryoSleep || '_' || HomePlanet AS CryoHome FROM e3)""",
        "e5 AS (SELECT * REPLACE (" + ", ".join(
            f"CASE WHEN isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}" for c in NUM)
        + ") FROM e4)",
        "emed AS MATERIALIZED (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in NUM) + " FROM e5)",
        "feat AS MATERIALIZED (SELECT PassengerId, is_train, Transported, GroupId, Cabin, "
        + ", ".join(f"coalesce(e5.{c}, emed.m_{c}) AS {c}" for c in NUM) + ", " + ", ".join(CAT)
        + " FROM e5 CROSS JOIN emed)",
    ]


def feature_ctes() -> list[str]:
    return impute_ctes() + engineer_ctes()

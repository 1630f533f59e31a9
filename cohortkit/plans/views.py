"""Views over the generated TPC-H-style tables used by the tests, the
correctness checks and the benchmark.

``manifest`` has one row per order and the column layout of a passenger
manifest (packed ids, packed cabin path, names, five spend columns, two
nullable flags, a label known only for the training rows).  The generated
tables contain no NULLs, so gaps are introduced by integer arithmetic on the
order key; every rule below is plain SQL arithmetic so that another engine
computes exactly the same table.

``scores`` is a deterministic three-model probability table with ties on
purpose, standing in for out-of-fold model outputs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the manifest layout.
SPEND_COLS = ["RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck"]
ID_COL = "PassengerId"
LABEL_COL = "Transported"
TRAIN_FLAG = "is_train"
SCORE_MODELS = ["a", "b", "c"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of line prices by order and line number modulo 5, in one partial
    aggregation.  Decimal sums don't depend on the order of summation; a column
    without lines is null."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    slot = (F.col("l_linenumber") - 1) % 5
    return li.groupBy("l_orderkey").agg(*[F.sum(F.when(slot == i, F.col("price"))).cast("double").alias(f"_s{i}") for i in range(5)])


def manifest(spark: SparkSession, sf_dir: str, spend: bool = True) -> DataFrame:
    """One row per order.  The five spend columns are exact decimal sums over
    all lines of the order, dealt to the columns by line number modulo 5.
    ``spend=False`` leaves these columns out, and with them the aggregation of
    ``lineitem``, for plans that use none of them."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("o_orderkey")
    zero_spend = (k % 4) == 0
    seg = F.col("c_mktsegment")
    base = (
        o.join(c, o.o_custkey == c.c_custkey, "left")
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    if spend:
        base = base.join(_spend(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    is_train = (k % 5) != 3
    label = ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)) | (
        (F.col("o_orderstatus") != "F") & (F.col("o_totalprice") > 400000))
    cols = [
        F.concat(F.col("o_custkey").cast("string"), F.lit("_"), k.cast("string")).alias(ID_COL),
        F.when(k % 7 != 0, F.col("r_name")).alias("HomePlanet"),
        F.when(k % 9 != 0, F.col("o_orderstatus") == "F").alias("CryoSleep"),
        F.when(k % 5 != 0, F.concat(F.substring(seg, 1, 1), F.lit("/"), (k % 500).cast("string"), F.lit("/"),
                                   F.when(k % 2 == 0, "P").otherwise("S"))).alias("Cabin"),
        F.when(k % 11 != 0, F.col("o_orderpriority")).alias("Destination"),
        F.when(k % 6 != 0, ((F.col("c_custkey") % 60) + (k % 20)).cast("double")).alias("Age"),
        F.when(k % 8 != 0, F.col("c_acctbal") > 8000).alias("VIP"),
        *[F.when(F.col(f"_s{i}").isNotNull() & zero_spend, F.lit(0.0)).otherwise(F.col(f"_s{i}")).alias(name)
          for i, name in enumerate(SPEND_COLS if spend else [])],
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .when(k % 17 == 0, F.concat(F.lit("F"), (k % 97).cast("string")))
        .otherwise(F.concat(F.lit("F"), (k % 97).cast("string"), F.lit(" "), F.col("n_name"))).alias("Name"),
        F.when(is_train, label).alias(LABEL_COL),
        is_train.alias(TRAIN_FLAG),
    ]
    return base.select(*cols)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide score table ``(PassengerId, Transported, p_a, p_b, p_c, split)`` for
    every labelled order; ``split`` is 'oof' for training rows, 'test'
    otherwise (label null)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey")
    is_train = (k % 5) != 3
    label = ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)) | (
        (F.col("o_orderstatus") != "F") & (F.col("o_totalprice") > 400000))
    y = label.cast("int")

    def p(mult: int, add: int, shift: int) -> F.Column:
        # residue in [0, 1009) moved towards the label, capped to [0, 1008]
        raw = (k * mult + add) % 1009 + y * shift
        return (F.least(raw, F.lit(1008)).cast("double") / 1009.0)

    return o.select(
        F.concat(F.col("o_custkey").cast("string"), F.lit("_"), k.cast("string")).alias(ID_COL),
        F.when(is_train, label).alias(LABEL_COL),
        p(37, 11, 300).alias("p_a"),
        p(101, 7, 200).alias("p_b"),
        p(211, 3, 120).alias("p_c"),
        F.when(is_train, "oof").otherwise("test").alias("split"),
    )


def long_scores(spark: SparkSession, sf_dir: str, split: str = "oof") -> DataFrame:
    from cohortkit.sources.io import read_scores

    s = scores(spark, sf_dir).where(F.col("split") == split)
    return read_scores(s, ID_COL, LABEL_COL if split == "oof" else None)


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined to their quality/toxicity labels (real 0/1 labels)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "inner")

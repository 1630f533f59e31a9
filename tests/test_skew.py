"""The skew-safe path of ``prefix_sums`` (keys above ``hot_rows`` are range
partitioned over many tasks) must give the same results as the plain window.
A tiny ``hot_rows`` forces the hot path at test scale; one key holds most rows."""

import math

from pyspark.sql import functions as F

from cohortkit.operators import ensemble as EN
from cohortkit.operators import evaluate as EV
from cohortkit.operators.windows import prefix_sums


def _skewed(spark, n=600):
    # key "hot" holds 2/3 of the rows, the others are small
    rows = [(i, "hot" if i % 3 else f"k{i % 7}", float((i * 37) % 101) / 100.0, (i * 11) % 5 % 2) for i in range(n)]
    return spark.createDataFrame(rows, "id int, g string, p double, y int")


def test_prefix_sums_hot_path_equals_window(spark):
    df = _skewed(spark)
    sums = {"cs": F.col("y").cast("long"), "cn": F.lit(1).cast("long")}
    cold = {r["id"]: (r["cs"], r["cn"]) for r in prefix_sums(df, ["g"], ["p", "id"], sums, hot_rows=10**9).collect()}
    hot = {r["id"]: (r["cs"], r["cn"]) for r in prefix_sums(df, ["g"], ["p", "id"], sums, hot_rows=50, partitions=7).collect()}
    assert cold == hot and len(hot) == 600
    glob_cold = {r["id"]: r["cn"] for r in prefix_sums(df, [], ["p", "id"], {"cn": F.lit(1)}, hot_rows=10**9).collect()}
    glob_hot = {r["id"]: r["cn"] for r in prefix_sums(df, [], ["p", "id"], {"cn": F.lit(1)}, hot_rows=50, partitions=5).collect()}
    assert glob_cold == glob_hot


def test_best_cut_and_auc_hot_path(spark):
    df = _skewed(spark)
    a = {r["g"]: (r["cut"], r["correct"]) for r in EN.best_cut(df, by=["g"], hot_rows=10**9).collect()}
    b = {r["g"]: (r["cut"], r["correct"]) for r in EN.best_cut(df, by=["g"], hot_rows=20).collect()}
    assert a == b
    m = df.withColumnRenamed("g", "model")
    x = {r["model"]: r["auc"] for r in EV.auc(m, hot_rows=10**9).collect()}
    y = {r["model"]: r["auc"] for r in EV.auc(m, hot_rows=20).collect()}
    assert x.keys() == y.keys() and all(math.isclose(x[k], y[k]) or (math.isnan(x[k]) and math.isnan(y[k])) for k in x)

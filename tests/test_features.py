"""Scalar and row-wise operators (FIXTURES.md section 3)."""

import math

from pyspark.sql import functions as F

from cohortkit.functions import columns as C
from cohortkit.operators.encode import standardize
from cohortkit.operators.features import group_size, split_first, split_packed


def test_split_id_malformed_and_path_null(spark):
    df = spark.createDataFrame([("0001_02",), ("x",), (None,)], "pid string")
    rows = split_packed(df, "pid", "_", [("g", 0, "string"), ("gn", 0, "double"), ("m", 1, "double")], known_flag="known").collect()
    assert (rows[0]["g"], rows[0]["gn"], rows[0]["m"], rows[0]["known"]) == ("0001", 1.0, 2.0, 1)
    assert (rows[1]["g"], rows[1]["gn"], rows[1]["m"]) == ("x", None, None)
    assert (rows[2]["g"], rows[2]["known"]) == (None, 0)


def test_split_name(spark):
    df = spark.createDataFrame([("Solo",), (None,), ("A B C",)], "n string")
    rows = split_first(df, "n", "first", "last").collect()
    assert [(r["first"], r["last"]) for r in rows] == [("Solo", "Unknown"), ("Unknown", None), ("A", "B C")]


def test_row_sum_std_and_count(spark):
    cols = ["a", "b", "c"]
    df = spark.createDataFrame([(None, None, None), (5.0, None, None), (1.0, 0.0, 3.0)], "a double, b double, c double")
    r = df.select(C.row_sum(cols, min_count=1).alias("raw"), C.row_sum(cols).alias("tot"),
                  C.row_std(cols, ddof=1, fill=0.0).alias("sd"), C.count_positive(cols).alias("used")).collect()
    assert (r[0]["raw"], r[0]["tot"], r[0]["used"]) == (None, 0.0, 0)
    assert r[1]["sd"] == 0.0
    assert math.isclose(r[2]["sd"], 1.5275252316519468) and r[2]["used"] == 2


def test_bool_text_clip_and_cross(spark):
    df = spark.createDataFrame([(True, 0.5, "a", "b"), (False, None, None, "b"), (None, 3.0, "a", None)],
                               "f boolean, x double, s string, t string")
    r = df.select(C.bool_text("f").alias("bt"), C.clip_lower("x", 1).alias("cx"), C.cross_text("s", "t").alias("st")).collect()
    assert [x["bt"] for x in r] == ["True", "False", "Unknown"]
    assert [x["cx"] for x in r] == [1.0, None, 3.0]
    assert [x["st"] for x in r] == ["a_b", None, None]


def test_group_size_null_key(spark):
    df = spark.createDataFrame([(1, "s"), (2, "s"), (3, None)], "id int, k string")
    out = {r["id"]: r["n"] for r in group_size(df, "k", "n", null_value=1.0).collect()}
    assert out == {1: 2.0, 2: 2.0, 3: 1.0}


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(4.0,), (4.0,), (4.0,)], "x double")
    tr, _ = standardize(df, df, ["x"])
    assert [r["x"] for r in tr.collect()] == [0.0, 0.0, 0.0]


def test_lookup_unmapped_is_null(spark):
    df = spark.createDataFrame([("A",), ("Q",), (None,)], "d string")
    assert [r[0] for r in df.select(C.lookup("d", {"A": "Europa"})).collect()] == ["Europa", None, None]

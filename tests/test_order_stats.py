"""Exact order statistics against numpy, whatever the number of narrowing
rounds, with a hot key, null keys, ties, extreme values and empty input."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import order_stats as OS
from cohortkit.operators import profile as PR
from cohortkit.operators.impute import Level, cascade, group_stats, median_stats, mode_stats

PROBS = [0.0, 0.25, 0.333, 0.5, 0.95, 1.0]


def _values(n=3000, seed=3):
    rng = np.random.default_rng(seed)
    key = rng.choice(["hot", "b", None, "one"], n, p=[0.7, 0.2, 0.09, 0.01])
    value = np.r_[rng.standard_normal(n // 2) * 1e6, rng.integers(0, 30, n - n // 2)].astype(object)
    value[::9] = None
    value[1:6] = [1e308, -1e308, 5e-324, -5e-324, 0.0]
    return pd.DataFrame({"k": key, "value": value})


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_quantiles_equal_numpy(spark, rounds):
    pdf = _values()
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k string, value double")
    got = {r["k"]: r for r in OS.quantiles_by(df, ["k"], PROBS, rounds).collect()}
    for k, g in pdf.groupby("k", dropna=False):
        k = None if isinstance(k, float) else k
        known = g.value.dropna().astype(float).to_numpy()
        assert got[k]["n"] == len(known)
        assert np.allclose(got[k]["q"], np.quantile(known, PROBS), rtol=1e-12)


def test_cells_never_decrease(spark):
    values = sorted([0.0, -0.0, 5e-324, 1e-300, 1e-7, 1e-6, 0.1, 0.1000001, 1.0, 7.0, 1e6, 1e300, 1.7e308, math.inf] + [-x for x in (1e-300, 1e-6, 0.1, 1.0, 1e6, 1e308, math.inf)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    cells = [r["c"] for r in df.withColumn("c", OS.cell(F.col("v"))).orderBy("i").collect()]
    assert cells == sorted(cells)


def test_plan_has_no_value_maps(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 2.0, "x"), (None, None, "y")], "k string, v double, s string")
    for stats in (median_stats(df, "v", ["k"]), mode_stats(df, "s", ["k"]), PR.quantiles(df, ["v"])):
        plan = stats._jdf.queryExecution().executedPlan().toString().lower()
        assert not any(f"functions=[{f}(" in plan or f", {f}(" in plan or f"partial_{f}(" in plan for f in ("percentile", "median", "mode"))


def test_stats_by_plans_agree(spark):
    pdf = _values(900)
    pdf["m"] = ["p", "q", "r", None, "q"] * 180
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k string, value double, m string")
    one = {r["k"]: r for r in group_stats(df, ["k"], ["m"], ["value"], rounds=0).collect()}
    two = {r["k"]: r for r in group_stats(df, ["k"], ["m"], ["value"], rounds=1).collect()}
    assert one.keys() == two.keys()
    for k in one:
        assert one[k]["__stat_m"] == two[k]["__stat_m"] and math.isclose(one[k]["__stat_value"], two[k]["__stat_value"])


def test_mode_ties_take_the_least_value(spark):
    df = spark.createDataFrame([("a", 10), ("a", 9), ("a", None)], "k string, v int")
    for rounds in (0, 1):
        assert group_stats(df, ["k"], ["v"], rounds=rounds).first()["__stat_v"] == 9


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([("a", None)], "k string, value double")
    assert OS.quantiles_by(df, ["k"], [0.5]).count() == 0
    assert OS.quantiles_by(df.limit(0), ["k"], [0.5], 2).count() == 0


@pytest.mark.parametrize("cut", [0, 1, 2])
def test_cascade_levels_at_once_and_row_steps(spark, cut):
    rows = [(i, "ab"[i % 2], None if i % 3 == 0 else float(i % 5), None if i % 4 == 0 else "xyz"[i % 3], None if i % 5 == 0 else float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, k string, v double, m string, w double")
    one = cascade(df, [Level(["k"], modes=["m"]), Level(["k"], medians=["v"]), lambda d: d.withColumn("w", F.coalesce("w", F.lit(1.0))), Level([], medians=["w"])], cut_every=cut)
    two = cascade(df, [[Level(["k"], modes=["m"]), Level(["k"], medians=["v"])], lambda d: d.withColumn("w", F.coalesce("w", F.lit(1.0)))], cut_every=cut, narrow=True)
    a, b = ({r["id"]: tuple(r) for r in x.collect()} for x in (one, two))
    assert a == b and len(a) == 60 and not any(v is None for r in a.values() for v in r)
    with pytest.raises(ValueError):
        cascade(df, [[Level(["k"], medians=["v"]), Level([], medians=["v"])]])


def test_kde_error_bound(spark):
    rng = np.random.default_rng(1)
    x = np.r_[rng.standard_normal(400), rng.standard_normal(100) * 0.01 + 3]
    df = spark.createDataFrame([("a", float(v)) for v in x] + [("flat", 2.0), ("flat", 2.0), ("none", None)], "c string, x double")
    for bins in (64, 512):
        rows = [r for r in PR.kde(df, "x", "c", grid=32, bins=bins).collect()]
        got = sorted((r["point"], r["x"], r["density"]) for r in rows if r["c"] == "a")
        h = x.std(ddof=1) * len(x) ** -0.2
        step = (x.max() - x.min()) / bins
        peak = 1 / (h * math.sqrt(2 * math.pi))
        for _, p, d in got:
            exact = np.exp(-0.5 * ((p - x) / h) ** 2).mean() * peak
            assert abs(d - exact) <= step**2 / (8 * h**2) * peak + 1e-12
        assert all(r["density"] is None for r in rows if r["c"] == "flat") and not any(r["c"] == "none" for r in rows)

"""Thresholds, group cuts, evaluation metrics (FIXTURES.md section 3) and
property checks with hypothesis."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortkit.operators import ensemble as EN
from cohortkit.operators import evaluate as EV
from cohortkit.operators.profile import histogram, iqr_outliers
from cohortkit.operators.splits import stratified_kfold


def _scores(spark, ps, ys, model="m"):
    return spark.createDataFrame([(i, model, float(p), int(y)) for i, (p, y) in enumerate(zip(ps, ys))],
                                 "id int, model string, p double, y int")


def test_threshold_cases(spark):
    r = EN.best_cut(_scores(spark, [0.3, 0.6, 0.9], [1, 1, 1])).first()
    assert r["cut"] == float("-inf") and r["accuracy"] == 1.0
    r = EN.best_cut(_scores(spark, [0.1, 0.2, 0.8, 0.9], [0, 0, 1, 1])).first()
    assert r["cut"] == 0.2 and r["accuracy"] == 1.0
    r = EN.best_cut(_scores(spark, [0.5, 0.5], [0, 1])).first()
    assert r["cut"] == float("-inf") and r["accuracy"] == 0.5


def test_group_cuts_min_count_and_unseen(spark):
    rows = [(i, "big" if i < 100 else "small", 0.9 if i % 2 else 0.1, i % 2) for i in range(199)]
    df = spark.createDataFrame(rows, "id int, g string, p double, y int")
    cuts = {r["group"]: r["cut"] for r in EN.group_cuts(df, "g", 0.42, min_count=100).collect()}
    assert cuts["big"] == 0.1 and cuts["small"] == 0.42
    other = spark.createDataFrame([(0, "new", 0.5)], "id int, g string, p double")
    d = EN.apply_cuts(other, "g", EN.group_cuts(df, "g", 0.42), 0.42).first()
    assert d["decision"] is True  # unseen group -> default cut 0.42


def test_metrics_zero_division_and_auc_ties(spark):
    m = EV.metrics(_scores(spark, [0.1, 0.2, 0.3], [0, 1, 1])).first()
    assert m["precision"] == 0.0 and m["f1"] == 0.0
    a = EV.auc(_scores(spark, [0.5, 0.5, 0.9, 0.1], [0, 1, 1, 0])).first()["auc"]
    assert math.isclose(a, 0.875)


def test_reliability_bounds(spark):
    df = _scores(spark, [1.0] * 30 + [0.05] * 20 + [0.55] * 21, [1] * 30 + [0] * 20 + [1] * 21)
    bins = {r["bin"]: r["n"] for r in EV.reliability(df).collect()}
    assert bins == {6: 21}  # p = 1 falls in no bin; a 20-row bin is dropped


def test_histogram_max_and_iqr_fence(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4]], "x double")
    h = {r["bin"]: r["n"] for r in histogram(df, ["x"], None, bins=4).collect()}
    assert h[3] == 2  # the maximum falls in the last (closed) bin
    # q1 = 1, q3 = 3, fences -2 and 6: 6 is exactly on the fence
    df2 = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 6]], "x double")
    q1q3 = iqr_outliers(df2, ["x"]).first()
    assert q1q3["outliers"] == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1, allow_nan=False), st.integers(0, 1)), min_size=2, max_size=40))
def test_threshold_properties(spark, rows):
    ps, ys = [r[0] for r in rows], [r[1] for r in rows]
    best = EN.best_cut(_scores(spark, ps, ys)).first()
    n = len(rows)
    assert best["accuracy"] >= sum(ys) / n - 1e-12  # never worse than all-positive
    again = sum((p > best["cut"]) == (y == 1) for p, y in zip(ps, ys)) / n
    assert math.isclose(again, best["accuracy"])


def test_kfold_disjoint_covering_balanced(spark):
    df = spark.createDataFrame([(f"id{i}", i % 3 == 0) for i in range(103)], "id string, y boolean")
    f = stratified_kfold(df, "id", "y", k=5, seeds=(2026, 42))
    assert f.count() == 206 and f.select("id", "seed").distinct().count() == 206
    per = f.join(df, "id").groupBy("seed", "y", "fold").count().groupBy("seed", "y").agg(
        (F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r["spread"] <= 1 for r in per)


def test_tune_blend_equals_brute_force(spark, monkeypatch):
    import random

    from cohortkit.operators import ensemble as EN

    monkeypatch.setattr(EN, "BLEND_FINAL", 4)
    rng = random.Random(8)
    for kind in ("spread", "ties", "equal"):
        rows = []
        for i in range(240):
            y = rng.randint(0, 1)
            score = {"spread": lambda: min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.25))), "ties": lambda: rng.randint(0, 4) / 4, "equal": lambda: 0.25 + 0.5 * y}[kind]
            rows.append((i, y, score(), score(), score()))
        best = None
        for i in range(1, 19):
            for j in range(1, 20 - i):
                s = sorted(((i / 20) * a + (j / 20) * b + ((20 - i - j) / 20) * c, y) for _, y, a, b, c in rows)
                tries = [(sum(y for _, y in s), float("-inf"))]
                tries += [(sum((p > cut) == (y == 1) for p, y in s), cut) for cut in sorted({p for p, _ in s})]
                right, cut = max(tries, key=lambda t: (t[0], -t[1] if t[1] > float("-inf") else float("inf")))
                if best is None or right > best[0]:
                    best = (right, i / 20, j / 20, cut)
        got = EN.tune_blend(spark.createDataFrame(rows, "id int, y int, a double, b double, c double"), ["a", "b", "c"], steps=20).first()
        assert (got["correct"], got["w_a"], got["w_b"], got["cut"]) == best and got["n"] == 240, kind


def test_stack_columns_and_faults(spark):
    from cohortkit.operators.ensemble import stack_columns, stack_faults

    long = spark.createDataFrame([(1, "a", 0.1), (1, "b", 0.2), (2, "a", 0.3), (3, "a", 0.4), (3, "a", 0.5), (3, "b", 0.6), (None, "b", 0.7)], "id int, model string, p double")
    got = {r["id"]: (r["a"], r["b"], r["whole"]) for r in stack_columns(long, ["id"], "model", "p", ["a", "b"]).collect()}
    assert got == {1: (0.1, 0.2, True), 2: (0.3, None, False), 3: (0.5, 0.6, False), None: (None, 0.7, False)}
    faults = sorted(((r["id"] or 0, r["model"], r["n"]) for r in stack_faults(long, ["id"], "model", ["a", "b"]).collect()))
    assert faults == [(0, "a", 0), (2, "b", 0), (3, "a", 2)]


def test_best_worst_and_average(spark):
    from cohortkit.operators import evaluate as EV

    table = spark.createDataFrame([("a", 0.8, 5.0), ("b", 0.9, 7.0), ("c", None, 6.0)], "model string, accuracy double, seconds double")
    got = {r["metric"]: tuple(r)[1:] for r in EV.leaders(table, ["accuracy"], ["seconds"]).collect()}
    assert got == {"accuracy": ("b", 0.9, "a", 0.8), "seconds": ("a", 5.0, "b", 7.0)}
    assert {r["model"]: r["cost_rank"] for r in EV.cost_ranks(table, "seconds").collect()} == {"a": 1, "c": 2, "b": 3}
    long = spark.createDataFrame([(i, m, i % 2, p) for i in range(8) for m, p in (("good", 0.9 if i % 2 else 0.1), ("bad", 0.4 if i % 2 else 0.6))], "id int, model string, y int, p double")
    rows = {r["model"]: (r["place"], r["behind"]) for r in EV.against_average(long).collect()}
    assert rows == {"good": (1, 0.0), "bad": (2, 1.0), "average": (None, 0.0)}

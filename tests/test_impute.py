"""Imputation edge cases (FIXTURES.md section 3)."""

from cohortkit.operators.impute import Level, cascade, fill_median, fill_mode, infer_flag, repair_flag


def _by_id(df, col):
    return {r["id"]: r[col] for r in df.collect()}


def test_mode_tie_null_key_and_all_null_group(spark):
    df = spark.createDataFrame(
        [(1, "g", "b"), (2, "g", "a"), (3, "g", None), (4, "h", None), (5, None, "z"), (6, None, None)],
        "id int, k string, v string")
    out = _by_id(fill_mode(df, "v", ["k"]), "v")
    assert out[3] == "a"          # tie -> smallest value
    assert out[4] is None         # all-null group stays null
    assert out[6] == "z"          # a NULL key is a group of its own
    assert out[1] == "b" and out[2] == "a"  # known values never change


def test_median_even_count_then_global(spark):
    df = spark.createDataFrame([(1, "g", 1.0), (2, "g", 2.0), (3, "g", None), (4, "h", None), (5, "i", 10.0)],
                               "id int, k string, x double")
    out = _by_id(fill_median(df, "x", [["k"]]), "x")
    assert out[3] == 1.5
    assert out[4] == 1.75         # global median sees level 1 filled: (1, 1.5, 2, 10)


def test_cascade_levels_see_filled_values(spark):
    # level 1 (by a) fills row 3 with "x"; level 2 (by b) must then see x,x,y -> mode x for row 4
    df = spark.createDataFrame([(1, "a1", "b1", "x"), (2, "a1", "b1", None), (3, "a1", "b2", None),
                                (4, "a2", "b1", None), (5, "a2", "b1", "y")], "id int, a string, b string, v string")
    out = _by_id(cascade(df, [Level(keys=["a"], modes=["v"]), Level(keys=["b"], modes=["v"])]), "v")
    assert out[2] == "x" and out[3] == "x"
    assert out[4] == "y"          # level 1 by a2 already filled it from row 5


def test_flag_rule_and_repair(spark):
    cols = ["s1", "s2"]
    df = spark.createDataFrame([(1, None, 3.0, None), (2, None, 0.0, None), (3, None, None, None), (4, True, 3.0, 0.0)],
                               "id int, f boolean, s1 double, s2 double")
    out = _by_id(infer_flag(df, "f", cols), "f")
    assert out[1] is False and out[2] is True and out[3] is True
    rep = repair_flag(df.selectExpr("id", "f", "s1 + s2 AS total"), "f", "total")
    assert _by_id(rep, "f")[4] is False


def test_approx_median_opt_in(spark):
    df = spark.createDataFrame([(1, "g", 1.0), (2, "g", 2.0), (3, "g", 3.0), (4, "g", None)], "id int, k string, x double")
    assert _by_id(fill_median(df, "x", [["k"]], approx_medians=True), "x")[4] == 2.0
    assert _by_id(fill_median(df, "x", [["k"]]), "x")[4] == 2.0


def test_cascade_plans_agree_and_few_keys_move_no_rows(spark, monkeypatch):
    from cohortkit.operators import impute

    rows = [(i, f"k{i * 7 % 5}" if i % 11 else None, f"v{i * i % 3}" if i % 4 else None, float(i * 13 % 17) if i % 3 else None, None if i % 6 else i % 4 == 0) for i in range(200)]
    rows += [(200 + i, "lone" if i else None, None, float("nan") if i else None, None) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, k string, m string, x double, b boolean")
    steps = [Level(["k"], modes=["m", "b"], medians=["x"]), Level(["m"], medians=["x"], modes=["b"]), Level([], medians=["x"])]
    read = lambda d: sorted(map(str, d.select("id", "k", "m", "x", "b").collect()))
    few = cascade(df, steps, cut_every=1)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and "Union" not in plan
    want = read(cascade(df, steps))
    assert read(few) == want
    monkeypatch.setattr(impute, "FEW_KEYS", 0)
    assert read(cascade(df, steps, cut_every=1)) == want  # within the groups
    assert read(cascade(df, steps, cut_every=1, narrow=True)) == want  # by joins

"""Registered queries against their DuckDB oracle SQL on the smallest
generated tables (the driver runs the same comparison at sf0.01)."""

import os

import pytest

SF = "/root/testdata/sf0.001"
NAMES = ["prj_select", "str_split_id", "row_stats", "agg_mode", "agg_crosstab_norm", "imp_mode", "imp_median",
         "prof_missing", "prof_moments", "prof_outlier", "stat_chi2", "win_size", "ev_metrics", "ev_auc",
         "ens_threshold", "ens_group_thr"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, name):
    import __spark_entry__ as entry
    from checks.compare import compare, duck

    qs, sqls = entry.queries(), entry.oracle_sql()
    assert name in qs and name in sqls
    res = compare(spark, duck(SF), name, qs[name], sqls[name], SF)
    assert res[1] == "ok", res


def test_every_query_has_a_callable():
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 90

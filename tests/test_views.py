import os

import pytest
from pyspark.sql import functions as F

from cohortkit.plans import views

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")


def test_spend_sums_cover_all_of_lineitem(spark):
    spend = views._spend(spark, SF)
    total = spend.select(sum(F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) for i in range(5)).alias("s")).agg(F.sum("s")).first()[0]
    lines = views.table(spark, SF, "lineitem").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))).first()[0]
    assert total == pytest.approx(float(lines), rel=1e-12)


def test_without_spend_is_the_same_table_and_skips_lineitem(spark):
    slim, full = views.manifest(spark, SF, spend=False), views.manifest(spark, SF)
    assert set(full.columns) - set(slim.columns) == set(views.SPEND_COLS)
    assert slim.exceptAll(full.select(*slim.columns)).isEmpty() and slim.count() == full.count()
    assert not any("lineitem" in f for f in slim.inputFiles())

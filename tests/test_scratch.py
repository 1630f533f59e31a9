import os

from pyspark.sql import functions as F

from cohortkit.operators import train as TR
from cohortkit.operators.impute import Level, cascade
from cohortkit.runtime import checkpoint_dir, cut_lineage, outliving, scratch_tables


def tables(spark):
    at = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(at)) if os.path.isdir(at) else set()


def test_tables_of_a_block_are_deleted_but_those_that_outlive_it(spark):
    before = tables(spark)
    with scratch_tables():
        a = cut_lineage(spark.range(5), "first")
        with scratch_tables():
            b = cut_lineage(a.withColumn("x", F.col("id") * 2), "second")
            with outliving():
                c = cut_lineage(b.groupBy("x").count(), "third")
        assert {t.split("-")[0] for t in tables(spark) - before} == {"first", "third"} and c.count() == 5
    assert tables(spark) == before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_a_cascade_keeps_its_last_table_only(spark):
    before = tables(spark)
    df = spark.range(60).select("id", (F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("v"))
    out = cascade(df, [Level(["k"], modes=["v"]), lambda d: d.withColumn("w", F.col("v") + 1), lambda d: d.withColumn("w", F.col("w") + 1)], cut_every=2)
    assert out.where("w is null").isEmpty() and out.count() == 60
    assert sorted(t.split("-")[0] for t in tables(spark) - before) == ["changed", "stats"]


def test_folds_leave_scores_only(spark):
    before = tables(spark)
    df = spark.range(200).select("id", (F.col("id") % 2 + F.rand(1)).alias("x"), (F.col("id") % 3).cast("string").alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    folds = df.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("seed"), (F.col("id") % 3 % 2).cast("int").alias("fold"))
    o, _, _ = TR.oof(df, folds, "rf", ["x"], ["c"], "y", params={"numTrees": 2, "maxDepth": 2})
    assert o.count() == 400
    assert sorted(t.split("-")[0] for t in tables(spark) - before) == ["oof"] * 4 + ["splits"]

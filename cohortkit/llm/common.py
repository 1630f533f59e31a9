"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.operators.windows import prefix_sums
from cohortkit.runtime import cut_lineage

__all__ = ["table", "written", "shipped", "packed", "running_sum", "unit_random"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and read
    again: computed once, and a lost executor loses nothing."""
    return cut_lineage(df, f"llm-{name}")


def packed(df: DataFrame, name: str, *extra: Column) -> DataFrame:
    """``df`` written as ``row``, a number of each row that holds from then on, and
    ``doc``, a struct of all its columns, so that no column of the caller's can
    clash with one that is added; and the columns ``extra``."""
    return written(df.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"), *extra), name)


def shipped(spark: SparkSession, path: str) -> str:
    """Send a file of the driver with the job; tasks open it at
    ``SparkFiles.get`` of the returned name."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def running_sum(df: DataFrame, order: list[Column], value: Column, out: str, inclusive: bool = False) -> DataFrame:
    """Running sum over the whole table in ``order``, by range partitions at
    every size, so no task sorts the table."""
    return prefix_sums(df, [], order, {out: value}, inclusive=inclusive)


def unit_random(*cols: Column | int | str) -> Column:
    """A reproducible uniform number strictly between 0 and 1 from a hash."""
    h = F.xxhash64(*[F.lit(c) if not isinstance(c, Column) else c for c in cols])
    return (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))

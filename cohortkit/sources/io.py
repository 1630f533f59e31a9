"""Readers and writers.

* ``read_table``  - Parquet / CSV / JSON scan with an optional explicit schema
  (CSV never relies on inference unless asked to).
* ``read_scores`` - a wide probability table (``p_<model>`` columns) turned
  into the long form ``(id, model, y, p)`` that every ensemble and
  evaluation operator consumes; models are discovered by prefix.
* ``read_optional`` - a side table that may be absent: empty DataFrame with the
  given schema instead of an error.
* ``write_table`` - overwrite-mode sink; ``save_model`` / ``load_model`` persist
  fitted pipelines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

__all__ = [
    "read_table", "read_optional", "path_exists", "read_scores", "score_columns",
    "write_table", "save_model", "load_model",
]


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None,
               header: bool = True, infer: bool = False) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header).option("inferSchema", infer and schema is None)
        # An empty CSV field is a missing value, as in pandas' reader.
        reader = reader.option("nullValue", "").option("emptyValue", None)
    return reader.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file reader finds ``path``, in any storage it can read
    (listing names only: no file is opened)."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_optional(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                  required: bool = False) -> DataFrame:
    """Read ``path`` if present; otherwise an empty DataFrame with ``schema``
    (or an error when ``required``), so downstream sections can be skipped by
    an emptiness test rather than a crash."""
    if path_exists(spark, path):
        return read_table(spark, path, fmt=fmt, schema=schema)
    if required:
        raise FileNotFoundError(path)
    if isinstance(schema, str):
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)


def score_columns(df: DataFrame, prefix: str = "p_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def read_scores(df: DataFrame, id_col: str, label_col: str | None, prefix: str = "p_",
                models: Sequence[str] | None = None) -> DataFrame:
    """Wide ``p_<model>`` columns -> long ``(id, model, y, p)``.

    Only the leading prefix is removed from the model name (``p_top_p`` ->
    ``top_p``).  ``y`` is the label as 0/1 int (null when there is no label).
    """
    cols = [f"{prefix}{m}" for m in models] if models else score_columns(df, prefix)
    y = F.col(label_col).cast("int") if label_col else F.lit(None).cast("int")
    base = df.select(F.col(id_col).alias("id"), y.alias("y"), *[F.col(c).cast("double").alias(c[len(prefix):]) for c in cols])
    names = [c[len(prefix):] for c in cols]
    return base.unpivot(["id", "y"], names, "model", "p")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, header: bool = True) -> str:
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)

"""Registry of checked queries: name -> (spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def float32(df: DataFrame, cols=None) -> DataFrame:
    """Cast double columns to float for the comparison (summation order of
    two engines differs in the last bits of a double)."""
    cols = set(cols) if cols is not None else {f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)}
    return df.select(*[F.col(c).cast("float").alias(c) if c in cols else F.col(c) for c in df.columns])

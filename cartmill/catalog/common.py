"""Small helpers shared by the catalogue modules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmill.session import WRITTEN, scratch_root


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round fractional results, whose last digits depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the scratch area, removed by ``clear_scratch``."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    WRITTEN.append(path)
    return path

"""Shared by the directory readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_feed(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A frame with no rows and the feed's own columns."""
    return spark.createDataFrame([], schema)


def read_or_empty(
    spark: SparkSession, schema: T.StructType | str, read: Callable[[], DataFrame]
) -> DataFrame:
    """``read()``, or a typed frame with no rows where the folder does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty_feed(spark, schema)
        raise


def fail(message: Column | str) -> Column:
    return F.raise_error(message).cast("string")

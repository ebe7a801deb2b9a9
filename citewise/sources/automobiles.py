"""The automobiles feed: XML with one element per vehicle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citewise.schemas import AUTOMOBILE_ROOT, AUTOMOBILE_ROW, OWNER_COLUMN, automobiles_schema
from citewise.sources.lexers import XmlLexer
from citewise.sources.paths import fail, read_or_empty
from citewise.sources.ranges import RECORDS, read_records

FILES = "*.xml"

# Spark puts elements that the schema does not name into this column.
_OTHERS = "xs_any"
_XML = {"rowTag": AUTOMOBILE_ROW, "nullValue": "", "mode": "FAILFAST", "wildcardColName": _OTHERS}


def read_automobiles(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    range_bytes: int | None = None,
    files: str = FILES,
) -> DataFrame:
    """All XML files of a folder, one row per vehicle, every column as text.

    A missing or empty element is NULL; a vehicle without an owner is dropped; an
    element that is not in ``columns``, or stands beside the vehicles, fails the job, as
    does a document that is broken or cut off. Documents are read in ranges of
    ``range_bytes``, by as many tasks; the rows are the same for any number.
    """
    records = automobile_records(spark, path, files, columns, range_bytes)
    return automobiles_from_records(records, columns)


def automobile_records(
    spark: SparkSession,
    path: str,
    files: str = FILES,
    columns: Sequence[str] | None = None,
    range_bytes: int | None = None,
) -> DataFrame:
    """(file, name, record): the children of each document's root, whatever their names."""
    lexer = XmlLexer(AUTOMOBILE_ROOT, AUTOMOBILE_ROW, automobiles_schema(columns).names)
    return read_or_empty(spark, RECORDS, lambda: read_records(spark, path, lexer, files, range_bytes))


def automobiles_from_records(records: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Vehicles out of records: the text of one child of the root element each.

    Records may say where they come from and which element they are (file, name).
    """
    schema = automobiles_schema(columns)
    where = F.concat("file", F.lit(": ")) if "file" in records.columns else F.lit("")
    vehicle = F.from_xml("record", _open(schema), _XML).alias("v")
    if "name" in records.columns:
        stray = F.concat(where, F.lit("an element "), F.col("name"), F.lit(f" stands where only {AUTOMOBILE_ROW} may"))
        records = records.where(F.when(F.col("name") == AUTOMOBILE_ROW, True).otherwise(F.raise_error(stray)))
    vehicles = records.select(where.alias("_where"), vehicle).select("_where", "v.*")
    others = F.concat("_where", F.lit("element outside the expected columns, with the text "), F.col(_OTHERS)[0])
    # The check sits in the filter column, which every reading of the feed evaluates.
    owner = F.when(F.col(_OTHERS).isNotNull(), fail(others)).otherwise(F.col(OWNER_COLUMN))
    return vehicles.where(F.length(owner) > 0).select(*schema.names)


def _open(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(_OTHERS, T.ArrayType(T.StringType()))])

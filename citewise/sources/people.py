"""The people feed: pipe-delimited text with a header line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citewise.schemas import PEOPLE_COLUMNS, people_schema, strings
from citewise.sources.lexers import CsvLexer
from citewise.sources.paths import empty_feed, read_or_empty
from citewise.sources.ranges import RECORDS, read_records

SEPARATOR = "|"


def read_people(
    spark: SparkSession,
    path: str,
    key_type: str = "bigint",
    schema: T.StructType | None = None,
    infer: bool = False,
    quoted_newlines: bool = False,
    range_bytes: int | None = None,
) -> DataFrame:
    """All CSV files of a folder as one frame.

    Columns go by the names in the header, types by ``schema``; columns it does not
    name stay, as text. Every file's header is checked against the first one's, so
    that a file with another column order fails and does not mix columns up. A line break
    in quotes belongs to its value, a quote in quotes is doubled, an empty value is NULL.
    Files are read in ranges of ``range_bytes``, by as many tasks; the rows are the same
    for any number. ``infer=True`` takes the types from the data instead, with Spark's own
    reader; with ``quoted_newlines=True`` a file is one task for it.
    """
    schema = schema or people_schema(key_type)
    reader = {"sep": SEPARATOR, "header": True}

    if infer:
        options = {"sep": SEPARATOR, "header": True, "multiLine": quoted_newlines}
        return read_or_empty(spark, schema, lambda: spark.read.csv(path, inferSchema=True, **options))
    names = header_of(spark, path)
    if names is None:
        return empty_feed(spark, schema)
    _require(schema.names, names)
    return _typed(_parsed(people_records(spark, path, names, range_bytes), names), schema)


def header_of(spark: SparkSession, path: str) -> list[str] | None:
    """The names in the first file's header; None without a folder or a file in it."""
    try:
        return spark.read.csv(path, sep=SEPARATOR, header=True).columns
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def people_records(
    spark: SparkSession, path: str, names: Sequence[str] | None = None, range_bytes: int | None = None
) -> DataFrame:
    """(file, name, record): the lines of each file as objects by the header's names."""
    names = header_of(spark, path) if names is None else names
    if names is None:
        return empty_feed(spark, RECORDS)
    return read_records(spark, path, CsvLexer(SEPARATOR, names), None, range_bytes)


def people_from_records(
    records: DataFrame,
    key_type: str = "bigint",
    more: Sequence[str] = (),
) -> DataFrame:
    """People out of bundle records: one object each, by the names in its file's header.

    Files may order their columns as they like. ``more`` names columns to keep beside
    the declared ones, as text; a file without such a column gives NULL.
    """
    return _typed(_parsed(records, [*PEOPLE_COLUMNS, *more]), people_schema(key_type))


def _parsed(records: DataFrame, names: Sequence[str]) -> DataFrame:
    person = F.from_json("record", strings(names), {"mode": "FAILFAST"})
    return records.select(person.alias("p")).select("p.*")


def _require(wanted: Sequence[str], header: Sequence[str]) -> None:
    missing = [name for name in wanted if name not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {header}")


def _typed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    _require(schema.names, lines.columns)
    declared = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    return lines.select(*declared, *[c for c in lines.columns if c not in schema.names])

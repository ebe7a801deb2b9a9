"""The speeding feed: JSON documents that hold one array of tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citewise.schemas import SPEEDING_ARRAY, SPEEDING_COLUMNS, speeding_schema, strings
from citewise.sources.lexers import JsonLexer
from citewise.sources.paths import read_or_empty
from citewise.sources.ranges import RECORDS, read_records

FILES = "*.json"

_STRICT = {"mode": "FAILFAST"}


def read_speeding(
    spark: SparkSession,
    path: str,
    key_type: str = "bigint",
    infer: bool = False,
    range_bytes: int | None = None,
    files: str = FILES,
) -> DataFrame:
    """All JSON files of a folder, one row per ticket; null elements are dropped.

    Broken JSON, and a document without the array, fail the job. Documents are read in
    ranges of ``range_bytes``, by as many tasks; the rows are the same for any number.
    ``infer=True`` takes the types from whole documents instead.
    """

    def inferred() -> DataFrame:
        documents = spark.read.json(path, multiLine=True, mode="FAILFAST", pathGlobFilter=files)
        if SPEEDING_ARRAY not in documents.columns:
            raise ValueError(f"no document has the key {SPEEDING_ARRAY}")
        return _tickets(documents)

    if infer:
        return read_or_empty(spark, speeding_schema(key_type), inferred)
    return speeding_from_records(speeding_records(spark, path, files, range_bytes), key_type)


def speeding_records(
    spark: SparkSession, path: str, files: str = FILES, range_bytes: int | None = None
) -> DataFrame:
    """(file, name, record): the elements of each document's array."""
    lexer = JsonLexer(SPEEDING_ARRAY)
    return read_or_empty(spark, RECORDS, lambda: read_records(spark, path, lexer, files, range_bytes))


def speeding_from_records(records: DataFrame, key_type: str = "bigint") -> DataFrame:
    """Tickets out of records: the text of one array element each."""
    text = F.col("record")
    # The check sits in the filter, which every reading of the feed evaluates.
    odd = F.raise_error(F.concat(F.lit("an element of the array is no object: "), F.substring(text, 1, 200)))
    present = records.where(F.when(text == "null", False).when(text.startswith("{"), True).otherwise(odd))
    ticket = F.from_json("record", strings(SPEEDING_COLUMNS), _STRICT)
    tickets = present.select(ticket.alias("_ticket")).select("_ticket.*")
    return _typed(tickets, speeding_schema(key_type))


def _tickets(documents: DataFrame) -> DataFrame:
    array = F.col(SPEEDING_ARRAY)
    missing = F.raise_error(F.lit(f"a document lacks the array {SPEEDING_ARRAY}"))
    checked = F.when(array.isNull(), missing).otherwise(array)
    return documents.select(F.inline(F.filter(checked, lambda ticket: ticket.isNotNull())))


def _typed(tickets: DataFrame, schema: T.StructType) -> DataFrame:
    """From text to the declared types: true/false and 1/0 are both read as flags."""
    return tickets.select(
        *[F.col(field.name).try_cast(field.dataType).alias(field.name) for field in schema]
    )

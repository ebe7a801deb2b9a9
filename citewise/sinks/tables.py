"""What a run leaves behind: staged feeds, trend tables, the report text.

Every writer puts its tables beside what is there and commits them at the end (see
``versions``), so a reader meets the old tables or the new ones, and a run that is
repeated after a failure starts anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citewise.functions.periods import year_of
from citewise.schemas import automobiles_schema, people_schema, speeding_schema
from citewise.sinks.versions import Publisher, published, read_published
from citewise.sources.load import Feeds, require_counted

STAGED = "staged"


def stage_feeds(feeds: Feeds, path: str, version: str = STAGED, gate: bool = False) -> None:
    """The feeds as parquet, once, so that every question scans only its columns.

    Each task writes its own rows, with no shuffle. Rows are counted while they are
    written; with ``gate`` an empty feed fails, by name, and nothing is committed.
    """
    spark = feeds.people.sparkSession
    publisher = Publisher(spark, path, version)
    if publisher.done():
        return
    counted = write_feeds(publisher, feeds)
    if gate:
        require_counted(counted)
    publisher.commit()


def write_feeds(publisher: Publisher, feeds: Feeds) -> dict[str, int]:
    """Writes the feeds as tables of a version; gives the rows of each."""
    rows = {}
    for name, frame in feeds._replace(speeding=with_year(feeds.speeding))._asdict().items():
        seen = Observation(name)
        publisher.write(name, frame.observe(seen, F.count(F.lit(1)).alias("rows")))
        rows[name] = seen.get.get("rows", 0)
    return rows


def with_year(tickets: DataFrame) -> DataFrame:
    return tickets.withColumn("ticket_year", F.year(year_of(F.col("ticket_time"))))


def read_staged(spark: SparkSession, path: str, key_type: str = "bigint") -> Feeds:
    return Feeds(
        *(read_published(spark, path, name, schema) for name, schema in staged_schemas(key_type)._asdict().items())
    )


def staged_schemas(key_type: str = "bigint") -> Feeds:
    """The columns of staged feeds."""
    tickets = speeding_schema(key_type).add("ticket_year", T.IntegerType())
    return Feeds(people_schema(key_type), tickets, automobiles_schema())


def write_trends(months: DataFrame, years: DataFrame, path: str, version: str | None = None) -> None:
    """Both count tables in the order of time, ready for a chart; ``read_published`` them
    as months and years. Without a version's name they replace what is there."""
    publisher = Publisher(months.sparkSession, path, version or uuid.uuid4().hex)
    if publisher.done():
        return
    publisher.write("months", months.orderBy("month"))
    publisher.write("years", years.orderBy("year"))
    publisher.commit()


def write_report(lines: DataFrame, path: str, run_id: str) -> str:
    """The report text of a run; gives its folder."""
    spark, name = lines.sparkSession, f"run_id={run_id}"
    publisher = Publisher(spark, path, run_id)
    if not publisher.done():
        publisher.write(name, lines, write_lines)
        publisher.commit()
    return published(spark, path, name, run_id)[0]


def write_lines(lines: DataFrame, folder: str) -> None:
    lines.orderBy("question", "line_no", "line").select("line").write.text(folder)


"""A whole run: feeds in; staged feeds, trend tables and report out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citewise.functions.fees import AS_CODED, FeeSchedule
from citewise.operators.counts import months_in, report_counts, years_from_months
from citewise.operators.ownership import estimate_hot
from citewise.plans.report import report_lines
from citewise.sinks.tables import staged_schemas, write_feeds, write_lines
from citewise.sinks.versions import Publisher, published
from citewise.sources.bundle import list_archives
from citewise.sources.census import census_of_members, require_expected
from citewise.sources.load import Feeds, require_counted
from citewise.streaming.arrivals import write_members

REPORT = "report"


def run_report(
    spark: SparkSession,
    feeds: Feeds,
    out: str,
    run_id: str,
    schedule: FeeSchedule = AS_CODED,
    key_type: str = "bigint",
    census: DataFrame | None = None,
) -> str:
    """Answers all questions about the feeds; gives the report's folder.

    The feeds are parsed once, into parquet, and counted on the way; an empty one fails.
    Of the staged tickets, one scan counts officers and months, another the fees; before
    it the plates are looked through for hot ones, column by column. All
    tables of a run (the feeds, counts, months, years, names and the report) are committed
    at once; a run that is committed is not repeated. With a ``census`` of the feeds'
    names, it is written too and checked before a feed is read.
    """
    publisher = Publisher(spark, out, run_id)
    if not publisher.done():
        _checked(publisher, census)
        require_counted(write_feeds(publisher, feeds))
        _answer(publisher, schedule, key_type)
    return published(spark, out, REPORT, run_id)[0]


def run_bundles(
    spark: SparkSession,
    bundles: str,
    out: str,
    run_id: str,
    schedule: FeeSchedule = AS_CODED,
    key_type: str = "bigint",
    fail_on_rejected: bool = False,
) -> str:
    """The same from a folder of bundles, which are listed once.

    The members that no feed takes are a table of the run, ``rejected``; with
    ``fail_on_rejected`` they end it. ``names`` tells which tags and keys the files use.
    """
    publisher = Publisher(spark, out, run_id)
    if not publisher.done():
        archives = list_archives(spark, bundles)
        require_counted(write_members(publisher, archives, key_type, None, fail_on_rejected))
        _checked(publisher, census_of_members(publisher.read("members")))
        _answer(publisher, schedule, key_type)
    return published(spark, out, REPORT, run_id)[0]


def _checked(publisher: Publisher, census: DataFrame | None) -> None:
    if census is not None:
        publisher.write("names", census)
        require_expected(publisher.read("names"))


def _answer(publisher: Publisher, schedule: FeeSchedule, key_type: str) -> None:
    """Counts, trends and report out of the feeds that are written; then the commit."""
    staged = Feeds(*(publisher.read(name, schema) for name, schema in staged_schemas(key_type)._asdict().items()))
    publisher.write("counts", report_counts(staged.speeding))
    counts = publisher.read("counts")
    months = months_in(counts)
    publisher.write("months", months.orderBy("month"))
    publisher.write("years", years_from_months(months).orderBy("year"))
    hot = estimate_hot(staged.automobiles, staged.speeding, staged.people)
    lines = report_lines(staged, schedule, counts, hot)
    publisher.write(REPORT, lines, write_lines, f"{REPORT}/run_id={publisher.version}")
    publisher.commit()

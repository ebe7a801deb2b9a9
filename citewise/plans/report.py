"""The answers as lines of text, still as a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citewise.functions.fees import AS_CODED, FeeSchedule
from citewise.functions.labels import (
    amount_line,
    full_name,
    joined_names,
    month_label,
    tickets_line,
)
from citewise.operators.counts import (
    month_keys_in,
    months_in,
    officers_in,
    report_counts,
    years_from_months,
)
from citewise.operators.ownership import Hot
from citewise.operators.topk import top_k
from citewise.operators.trends import change_since_previous
from citewise.plans.questions import Trends, top_officers_of, top_payers
from citewise.sources.load import Feeds
from citewise.workspace import shared_folder

# The wording of the report.
OFFICERS_LINE = "Officer(s) %s distributed the most speeding tickets: %d"
MONTHS_HEADING = "These are the top three months by total tickets written"
PAYERS_HEADING = "These are the top ten most ticketed drivers by total ticket dollars levied"
TRENDS_HEADING = "Tickets written per year and month, with the change since the one before"


def officer_lines(top: DataFrame) -> DataFrame:
    """One line with all tied names, however many."""
    named = top.select(full_name(F.col("first_name"), F.col("last_name")).alias("name"), "ticket_count")
    one = named.agg(
        joined_names(F.col("name")).alias("names"), F.max("ticket_count").alias("most")
    ).select(F.format_string(OFFICERS_LINE, "names", F.coalesce("most", F.lit(0))).alias("line"))
    return _lines("1", F.lit(1), one)


def month_lines(top: DataFrame) -> DataFrame:
    """A heading and a line per month, the busiest first."""
    position = _position(top, F.desc("ticket_count"), F.asc("yyyymm"))
    line = tickets_line(month_label(F.col("yyyymm")), F.col("ticket_count"))
    return _heading(top, "2", MONTHS_HEADING).union(_lines("2", F.col("_n"), position, line))


def payer_lines(top: DataFrame) -> DataFrame:
    """A heading and a line per person, the highest amount first."""
    position = _position(
        top,
        F.desc("total_ticketed_amount"),
        *[F.asc(name) for name in ("person_id", "first_name", "last_name")],
    )
    line = amount_line(
        full_name(F.col("first_name"), F.col("last_name")), F.col("total_ticketed_amount")
    )
    return _heading(top, "3", PAYERS_HEADING).union(_lines("3", F.col("_n"), position, line))


def trend_lines(trends: Trends) -> DataFrame:
    """A heading, a line per year, then a line per month. The calendar bounds both."""
    parts = [_heading(trends.years, "4", TRENDS_HEADING)]
    for period, pattern, counts in (
        ("year", "yyyy", trends.years),
        ("month", "yyyy-MM", trends.months),
    ):
        changes = change_since_previous(counts, period)
        line = F.concat(
            tickets_line(F.date_format(period, pattern), F.col("ticket_count")),
            F.when(F.col("change").isNotNull(), F.format_string(" (%+d)", "change")).otherwise(""),
        )
        # Lines go by time, the months (year * 100 + month) behind all years.
        number = F.year(period)
        if period == "month":
            number = 1_000_000 + number * 100 + F.month(period)
        parts.append(_lines("4", number, changes, line))
    return reduce(DataFrame.union, parts)


def report_lines(
    feeds: Feeds, schedule: FeeSchedule = AS_CODED, counts: DataFrame | None = None, hot: Hot = Hot()
) -> DataFrame:
    """(question, line_no, line) for all questions over the same three feeds.

    The tickets are scanned twice, for the counts and for the fees. ``counts`` is what
    ``report_counts`` gives, if it has been written already; otherwise that small table is
    written to the shared folder first, since Spark would scan once for each question.
    """
    if counts is None:
        counts = written_counts(feeds.speeding)
    months = months_in(counts)
    return reduce(
        DataFrame.union,
        [
            officer_lines(top_officers_of(officers_in(counts), feeds.people)),
            month_lines(top_k(month_keys_in(counts), "ticket_count", 3, "yyyymm")),
            payer_lines(top_payers(feeds.people, feeds.speeding, feeds.automobiles, schedule, hot=hot)),
            trend_lines(Trends(months, years_from_months(months))),
        ],
    )


def written_counts(tickets: DataFrame) -> DataFrame:
    """``report_counts``, written below the shared folder and read back."""
    spark, counts = tickets.sparkSession, report_counts(tickets)
    folder = shared_folder(spark, "report-counts")
    counts.write.parquet(folder)
    return spark.read.schema(counts.schema).parquet(folder)


def _position(top: DataFrame, *order: Column) -> DataFrame:
    """Numbers the rows of a top-k result."""
    return top.withColumn("_n", F.row_number().over(Window.orderBy(*order)))


def _heading(frame: DataFrame, question: str, text: str) -> DataFrame:
    return _lines(question, F.lit(0), frame.sparkSession.range(1), F.lit(text))


def _lines(question: str, number: Column, rows: DataFrame, line: Column | None = None) -> DataFrame:
    return rows.select(
        F.lit(question).alias("question"),
        number.cast("int").alias("line_no"),
        (F.col("line") if line is None else line).alias("line"),
    )

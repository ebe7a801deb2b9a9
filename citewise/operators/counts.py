"""Ticket counts by officer and by period.

Every count is a two-phase hash aggregate: map tasks shrink their rows to one per
key before the shuffle, so a key that holds a third of all tickets sends one row per
map task. Tickets with a NULL id are not counted; a NULL key is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citewise.functions.periods import month_key, month_of, year_of


def tickets_per_officer(
    tickets: DataFrame, officer: str = "officer_id", ticket: str = "id"
) -> DataFrame:
    return tickets.groupBy(officer).agg(F.count(ticket).alias("ticket_count"))


def tickets_per_month_key(
    tickets: DataFrame, time: str = "ticket_time", ticket: str = "id"
) -> DataFrame:
    return tickets.groupBy(month_key(F.col(time)).alias("yyyymm")).agg(
        F.count(ticket).alias("ticket_count")
    )


def month_counts(tickets: DataFrame, time: str = "ticket_time", ticket: str = "id") -> DataFrame:
    return tickets.groupBy(month_of(F.col(time)).alias("month")).agg(
        F.count(ticket).alias("ticket_count")
    )


def year_counts(tickets: DataFrame, time: str = "ticket_time", ticket: str = "id") -> DataFrame:
    return tickets.groupBy(year_of(F.col(time)).alias("year")).agg(
        F.count(ticket).alias("ticket_count")
    )


def years_from_months(months: DataFrame) -> DataFrame:
    """Year counts rolled up from month counts, with no second pass over the tickets."""
    return months.groupBy(F.date_trunc("year", "month").alias("year")).agg(
        F.sum("ticket_count").alias("ticket_count")
    )


def months_and_officers(
    tickets: DataFrame,
    officer: str = "officer_id",
    time: str = "ticket_time",
    ticket: str = "id",
) -> DataFrame:
    """Officer counts and month counts from one scan.

    ``kind`` tells the two sets apart, since a NULL officer or month is a real group.
    """
    keyed = tickets.select(
        F.col(officer).alias("officer_id"),
        month_of(F.col(time)).alias("month"),
        F.col(ticket).alias("_ticket"),
    )
    officers, months = F.col("officer_id"), F.col("month")
    return (
        keyed.groupingSets([[officers], [months]], officers, months)
        .agg(
            F.when(F.grouping("officer_id") == 0, "officer").otherwise("month").alias("kind"),
            F.count("_ticket").alias("ticket_count"),
        )
        .select("kind", "officer_id", "month", "ticket_count")
    )


def report_counts(
    tickets: DataFrame,
    officer: str = "officer_id",
    time: str = "ticket_time",
    ticket: str = "id",
) -> DataFrame:
    """What the questions about officers and months need, from one scan: tickets by
    officer, and by month and month key together (``kind`` tells them apart).

    As many rows as officers and months: small enough to be written and read again.
    """
    keyed = tickets.select(
        F.col(officer).alias("officer_id"),
        month_of(F.col(time)).alias("month"),
        month_key(F.col(time)).alias("yyyymm"),
        F.col(ticket).alias("_ticket"),
    )
    officers, months, keys = F.col("officer_id"), F.col("month"), F.col("yyyymm")
    return (
        keyed.groupingSets([[officers], [months, keys]], officers, months, keys)
        .agg(
            F.when(F.grouping("officer_id") == 0, "officer").otherwise("month").alias("kind"),
            F.count("_ticket").alias("ticket_count"),
        )
        .select("kind", "officer_id", "month", "yyyymm", "ticket_count")
    )


def officers_in(counts: DataFrame) -> DataFrame:
    """``tickets_per_officer``, out of ``report_counts``."""
    return counts.where("kind = 'officer'").select("officer_id", "ticket_count")


def months_in(counts: DataFrame) -> DataFrame:
    """``month_counts``, out of ``report_counts``."""
    return counts.where("kind = 'month'").groupBy("month").agg(F.sum("ticket_count").alias("ticket_count"))


def month_keys_in(counts: DataFrame) -> DataFrame:
    """``tickets_per_month_key``, out of ``report_counts``."""
    return counts.where("kind = 'month'").groupBy("yyyymm").agg(F.sum("ticket_count").alias("ticket_count"))


def max_count(counts: DataFrame, measure: str = "ticket_count") -> DataFrame:
    return counts.agg(F.max(measure).alias(f"max_{measure}"))


def with_max(counts: DataFrame, measure: str = "ticket_count") -> DataFrame:
    """All rows that hold the maximum, ties kept.

    The maximum is a scalar subquery over the same aggregate, whose shuffle Spark
    runs once and reads twice. A NULL maximum (no rows) keeps nothing.
    """
    return counts.where(F.col(measure) == counts.agg(F.max(measure)).scalar())

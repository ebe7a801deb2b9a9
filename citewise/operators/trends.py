"""Trends over the count tables of ``counts``.

Inputs here are one row per month or year, not tickets. The calendar bounds them
(years 1 to 9999 hold 119,988 months), so the ordered windows below, which need all
periods in one task, stay small whatever the number of tickets. Rows with no
period are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def change_since_previous(counts: DataFrame, period: str) -> DataFrame:
    """Adds ``change`` against the period before it that has tickets.

    A missing period sorts last and is taken out at the end. Taken out first, the
    filter would travel into the counting of tickets, and month and year changes
    could not share one scan.
    """
    in_order = Window.orderBy(F.asc_nulls_last(period))
    return counts.select(
        period,
        "ticket_count",
        (F.col("ticket_count") - F.lag("ticket_count").over(in_order)).alias("change"),
    ).where(F.col(period).isNotNull())


def seasonal_index(months: DataFrame) -> DataFrame:
    """Mean of each calendar month divided by the mean of all months."""
    months = months.where(F.col("month").isNotNull())
    return (
        months.groupBy(F.month("month").alias("month_number"))
        .agg(F.avg("ticket_count").alias("_mean"))
        .select(
            "month_number",
            (F.col("_mean") / months.agg(F.avg("ticket_count")).scalar()).alias("seasonal_index"),
        )
    )


def month_rank_in_year(months: DataFrame) -> DataFrame:
    """Rank of each month among the months of its year, the busiest first."""
    months = months.where(F.col("month").isNotNull()).withColumn("year", F.year("month"))
    busiest_first = Window.partitionBy("year").orderBy(F.desc("ticket_count"))
    return months.select(
        "year", "month", "ticket_count", F.rank().over(busiest_first).alias("month_rank")
    )


def month_grid(months: DataFrame) -> DataFrame:
    """Every month from the first to the last, with 0 where there are no tickets.

    Each month fills the gap up to the next one, so the counts are needed only once.
    """
    following = F.lead("month").over(Window.orderBy("month"))
    gap = F.expr("sequence(month, coalesce(_next - interval 1 month, month), interval 1 month)")
    return (
        months.where(F.col("month").isNotNull())
        .withColumn("_next", following)
        .select("ticket_count", F.posexplode(gap).alias("_behind", "_month"))
        .select(
            F.col("_month").alias("month"),
            F.when(F.col("_behind") == 0, F.col("ticket_count")).otherwise(0).alias("ticket_count"),
        )
    )

"""What a ticket costs, as an expression or as a lookup table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class FeeSchedule(NamedTuple):
    """The cost of a ticket in each of the four zone combinations."""

    base: int
    school: int
    work: int
    school_and_work: int


# Fees in dollars. PUBLISHED is the printed fee table. AS_CODED is
# what the job being matched charges: it adds the zone fee on top of the base fee.
PUBLISHED = FeeSchedule(base=30, school=60, work=60, school_and_work=120)
AS_CODED = FeeSchedule(base=30, school=90, work=90, school_and_work=120)


def _set(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def ticket_cost(school: Column, work: Column, schedule: FeeSchedule) -> Column:
    """The fee as a native BIGINT expression. A NULL flag counts as not set."""
    school, work = _set(school), _set(work)
    return (
        F.when(school & work, schedule.school_and_work)
        .when(school, schedule.school)
        .when(work, schedule.work)
        .otherwise(schedule.base)
        .cast("bigint")
    )


def fee_table(spark: SparkSession, schedule: FeeSchedule) -> DataFrame:
    """The same schedule as four rows (school, work, fee)."""
    return spark.sql(
        f"""
        SELECT * FROM VALUES
            (false, false, {schedule.base}L),
            (true, false, {schedule.school}L),
            (false, true, {schedule.work}L),
            (true, true, {schedule.school_and_work}L)
        AS fees(school, work, fee)
        """
    )


def with_fee_from_table(
    tickets: DataFrame,
    fees: DataFrame,
    school: Column,
    work: Column,
    name: str = "ticket_cost",
) -> DataFrame:
    """Adds the fee by joining ``fees`` on both flags.

    A left join: a combination that the table lacks gives a NULL fee, never a lost
    ticket. There is no hint; Spark sees the size of ``fees`` and decides.
    """
    fees = fees.select(
        F.col("school").alias("_school"), F.col("work").alias("_work"), F.col("fee").alias(name)
    )
    match = (_set(school) == F.col("_school")) & (_set(work) == F.col("_work"))
    return tickets.join(fees, match, "left").drop("_school", "_work")

"""The questions, each as one DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citewise.functions.fees import AS_CODED, FeeSchedule, ticket_cost
from citewise.operators.counts import (
    month_counts,
    tickets_per_month_key,
    tickets_per_officer,
    with_max,
    year_counts,
)
from citewise.operators.ownership import Hot, owner_totals
from citewise.operators.topk import top_k
from citewise.schemas import OFFICER_PROFESSION

# A top-k result is sent to every executor only up to this many rows.
BROADCAST_ROWS = 10_000

NAMES = ("first_name", "last_name")


class Trends(NamedTuple):
    months: DataFrame
    years: DataFrame


def officers_of(people: DataFrame, is_officer: Column | None = None) -> DataFrame:
    """The people who are officers."""
    if is_officer is None:
        is_officer = F.col("profession") == OFFICER_PROFESSION
    return people.where(is_officer)


def top_officers(
    people: DataFrame,
    tickets: DataFrame,
    is_officer: Column | None = None,
    names: Sequence[str] = NAMES,
    officer: str = "officer_id",
    ticket: str = "id",
    person: str = "id",
) -> DataFrame:
    """The officers with the most tickets, ties kept.

    The maximum is taken over all officer ids that tickets name. If it belongs to
    somebody who is no officer, the answer is empty.
    """
    counts = tickets_per_officer(tickets, officer, ticket)
    return top_officers_of(counts, people, is_officer, names, officer, person)


def top_officers_of(
    counts: DataFrame,
    people: DataFrame,
    is_officer: Column | None = None,
    names: Sequence[str] = NAMES,
    officer: str = "officer_id",
    person: str = "id",
) -> DataFrame:
    """The same, out of tickets that are counted already."""
    return _named_officers(with_max(counts), people, is_officer, names, officer, person)


def top_officers_strict(
    people: DataFrame,
    tickets: DataFrame,
    is_officer: Column | None = None,
    names: Sequence[str] = NAMES,
    officer: str = "officer_id",
    ticket: str = "id",
    person: str = "id",
) -> DataFrame:
    """The same with the maximum taken over officers only."""
    ids = officers_of(people, is_officer).select(F.col(person).alias("_officer")).distinct()
    # An inner join with distinct ids, not a semi join: Spark would push that below the
    # counts on one side of the maximum only, and scan the tickets twice.
    counts = tickets_per_officer(tickets, officer, ticket).join(
        ids, F.col(officer) == F.col("_officer")
    )
    top = with_max(counts.select(officer, "ticket_count"))
    return _named_officers(top, people, is_officer, names, officer, person)


def _named_officers(top, people, is_officer, names, officer, person) -> DataFrame:
    """Looks up the names of the few officers at the top.

    The match is null-safe, with NULL person ids left out first. A plain match would
    let Spark push "officer is not NULL" into the counts but not into their maximum,
    and the tickets would be scanned and shuffled once for each.
    """
    named = officers_of(people, is_officer).select(F.col(person).alias("_person"), *names)
    named = named.where(F.col("_person").isNotNull())
    return top.join(named, F.col(officer).eqNullSafe(F.col("_person"))).select(
        F.col(officer).alias("officer_id"), *names, "ticket_count"
    )


def top_months(
    tickets: DataFrame, k: int = 3, time: str = "ticket_time", ticket: str = "id"
) -> DataFrame:
    """The ``k`` months with the most tickets; of equal months, the earlier first."""
    return top_k(tickets_per_month_key(tickets, time, ticket), "ticket_count", k, "yyyymm")


def top_payers(
    people: DataFrame,
    tickets: DataFrame,
    automobiles: DataFrame,
    schedule: FeeSchedule = AS_CODED,
    k: int = 10,
    school: Column | None = None,
    work: Column | None = None,
    names: Sequence[str] = NAMES,
    ticket_plate: str = "license_plate",
    plate: str = "license_plate",
    owner: str = "person_id",
    person: str = "id",
    hot: Hot = Hot(),
) -> DataFrame:
    """The ``k`` people who owe most; of equal amounts, the lower id first.

    The cut to k comes before names are looked up: each person in the totals has at
    least one row in ``people``, so the first k rows after the look-up belong to the
    first k persons. Only those k rows are broadcast.
    """
    fee = ticket_cost(
        F.col("school_zone_ind") if school is None else school,
        F.col("work_zone_ind") if work is None else work,
        schedule,
    )
    totals = owner_totals(automobiles, tickets, people, fee, ticket_plate, plate, owner, person, hot)
    top = top_k(totals, "total_ticketed_amount", k, "person_id")
    if k <= BROADCAST_ROWS:
        top = F.broadcast(top)
    named = top.join(
        people.select(F.col(person).alias("_person"), *names), F.col("person_id") == F.col("_person")
    ).select("person_id", *names, "total_ticketed_amount")
    return top_k(named, "total_ticketed_amount", k, "person_id", *names)


def trend_tables(
    tickets: DataFrame, time: str = "ticket_time", ticket: str = "id"
) -> Trends:
    """Tickets per month and per year, each in the order of time."""
    return Trends(
        month_counts(tickets, time, ticket).orderBy("month"),
        year_counts(tickets, time, ticket).orderBy("year"),
    )

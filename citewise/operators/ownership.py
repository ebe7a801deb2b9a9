"""From tickets over vehicles to the people who pay."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citewise.operators.skew import hot_weights, join_spread


class Hot(NamedTuple):
    """Hot keys of the four join columns, with about how many rows each has."""

    owners: Mapping = {}
    persons: Mapping = {}
    plates: Mapping = {}
    ticketed: Mapping = {}


def estimate_hot(
    automobiles: DataFrame,
    tickets: DataFrame,
    people: DataFrame,
    ticket_plate: str = "license_plate",
    plate: str = "license_plate",
    owner: str = "person_id",
    person: str = "id",
) -> Hot:
    """Looks for hot keys: one job over the key columns, a sketch of a sample."""
    owned = _owned(automobiles, people, plate, owner, person)
    return Hot(*hot_weights((owned, "person_id"), (people, person), (owned, "_plate"), (tickets, ticket_plate)))


def _owned(automobiles, people, plate, owner, person, *more: Column) -> DataFrame:
    """(plate, person_id): the owner key in the type of the people key.

    Owner ids arrive as text. One that is no valid key becomes NULL and matches
    nobody, where a plain cast would fail the job under ANSI mode.
    """
    key_type = people.schema[person].dataType
    return automobiles.select(
        F.col(plate).alias("_plate"), F.col(owner).try_cast(key_type).alias("person_id"), *more
    )


def ticket_vehicle_owner(
    automobiles: DataFrame,
    tickets: DataFrame,
    people: DataFrame,
    fee: Column,
    ticket_plate: str = "license_plate",
    plate: str = "license_plate",
    owner: str = "person_id",
    person: str = "id",
    hot: Hot = Hot(),
) -> DataFrame:
    """One row (person_id, ticket_cost) per ticket, vehicle row and people row.

    Inner joins: a plate on several vehicle rows, or a person id on several people
    rows, repeats the ticket. Vehicles meet their owners first, the smaller join, and
    then the tickets. The plates and owners named in ``hot`` (see ``estimate_hot``) are
    spread over as many tasks as their rows ask for. Only where there are any, hashes of
    whole rows tell their rows apart, and all columns are read for them.
    """

    def rest(name: str, *found: Mapping) -> list[Column]:
        return [F.xxhash64("*").alias(name)] if any(found) else []

    apart = rest("_vehicle", hot.owners, hot.plates)
    owned = _owned(automobiles, people, plate, owner, person, *apart)
    charged = tickets.select(
        F.col(ticket_plate).alias("_ticket_plate"), fee.alias("ticket_cost"), *rest("_ticket", hot.ticketed)
    )
    persons = people.select(F.col(person).alias("_person"), *rest("_person_row", hot.persons))
    vehicles = join_spread(owned, "person_id", persons, "_person", hot.owners, hot.persons)
    return join_spread(vehicles, "_plate", charged, "_ticket_plate", hot.plates, hot.ticketed).select(
        "person_id", "ticket_cost"
    )


def owner_totals(
    automobiles: DataFrame,
    tickets: DataFrame,
    people: DataFrame,
    fee: Column,
    ticket_plate: str = "license_plate",
    plate: str = "license_plate",
    owner: str = "person_id",
    person: str = "id",
    hot: Hot = Hot(),
) -> DataFrame:
    """(person_id, total_ticketed_amount): the sum of ``ticket_vehicle_owner`` by person.

    The same numbers with the sums pushed below the joins. Fees are summed per plate
    first, so a plate with a third of all tickets meets the join as one row. A plate with
    a third of all vehicle rows, if ``hot`` names it, has them dealt to many tasks and its
    one sum repeated; hot plates and others go through the same join, so vehicles and
    tickets are read once. The sums per person follow; a person id that occurs n times in
    ``people`` then counts n times, as the row-level join would have it.
    """
    per_plate = (
        tickets.where(F.col(ticket_plate).isNotNull())
        .groupBy(F.col(ticket_plate).alias("_ticket_plate"))
        .agg(F.sum(fee).alias("_plate_total"))
    )
    owned = _owned(automobiles, people, plate, owner, person)
    owned = owned.where(F.col("person_id").isNotNull() & F.col("_plate").isNotNull())
    per_person = (
        join_spread(owned, "_plate", per_plate, "_ticket_plate", hot.plates, {})
        .groupBy("person_id")
        .agg(F.sum("_plate_total").alias("_person_total"))
    )
    copies = people.groupBy(F.col(person).alias("_person")).agg(F.count("*").alias("_copies"))
    return per_person.join(copies, F.col("person_id") == F.col("_person")).select(
        "person_id", (F.col("_person_total") * F.col("_copies")).alias("total_ticketed_amount")
    )

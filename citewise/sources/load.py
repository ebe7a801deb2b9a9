"""All three feeds at once, and the check that none of them is empty."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citewise.sources.automobiles import FILES as AUTOMOBILE_FILES
from citewise.sources.automobiles import automobiles_from_records, read_automobiles
from citewise.sources.bundle import (
    INFLATED,
    archive_bytes,
    bundle_members,
    list_archives,
    member_records,
    tasks_for,
)
from citewise.sources.people import people_from_records, read_people
from citewise.sources.speeding import FILES as SPEEDING_FILES
from citewise.sources.speeding import read_speeding, speeding_from_records


class Feeds(NamedTuple):
    people: DataFrame
    speeding: DataFrame
    automobiles: DataFrame


class EmptyFeedError(ValueError):
    """A feed has no rows."""


def load_directories(
    spark: SparkSession,
    people_dir: str,
    speeding_dir: str,
    automobiles_dir: str,
    key_type: str = "bigint",
    speeding_files: str = SPEEDING_FILES,
    automobile_files: str = AUTOMOBILE_FILES,
) -> Feeds:
    """The feeds from three folders; a folder that is missing gives a typed empty frame."""
    return Feeds(
        read_people(spark, people_dir, key_type),
        read_speeding(spark, speeding_dir, key_type, files=speeding_files),
        read_automobiles(spark, automobiles_dir, files=automobile_files),
    )


def feeds_from_archives(
    archives: DataFrame,
    key_type: str = "bigint",
    tasks: int | None = None,
    more_people: Sequence[str] = (),
) -> Feeds:
    """The feeds out of a frame of archive paths.

    ``more_people`` names columns of the people files to keep beside the declared ones.
    """
    return feeds_from_members(bundle_members(archives), key_type, tasks, more_people)


def feeds_from_members(
    members: DataFrame,
    key_type: str = "bigint",
    tasks: int | None = None,
    more_people: Sequence[str] = (),
) -> Feeds:
    """The same out of a frame of members, as ``bundle_members`` lists them."""
    records = {feed: member_records(members, feed, tasks) for feed in Feeds._fields}
    return Feeds(
        people_from_records(records["people"], key_type, more_people),
        speeding_from_records(records["speeding"], key_type),
        automobiles_from_records(records["automobiles"]),
    )


def load_bundles(
    spark: SparkSession,
    path: str,
    key_type: str = "bigint",
    tasks: int | None = None,
    more_people: Sequence[str] = (),
) -> Feeds:
    """The feeds from all zip bundles of a folder."""
    tasks = tasks or tasks_for(spark, INFLATED * archive_bytes(spark, path))
    return feeds_from_archives(list_archives(spark, path), key_type, tasks, more_people)


# Fixed value: the message of the gate.
EMPTY = "%s DataFrame is Empty!"


def require_rows(feeds: Feeds) -> Feeds:
    """The feeds, unless one is empty. Looks at one row of each."""
    for name, frame in feeds._asdict().items():
        if frame.isEmpty():
            raise EmptyFeedError(EMPTY % name.capitalize())
    return feeds


def require_counted(rows: dict[str, int]) -> None:
    """The same gate for feeds whose rows were counted while they were written."""
    for name in Feeds._fields:
        if not rows[name]:
            raise EmptyFeedError(EMPTY % name.capitalize())


def emptiness(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, is_empty) per table, as data. Looks at one row of each."""
    flags = [
        table.limit(1)
        .agg((F.count("*") == 0).alias("is_empty"))
        .select(F.lit(name).alias("table_name"), "is_empty")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.union, flags)

"""Which names the feeds' files use: tags, keys and header names, counted.

A table of (feed, name, expected, records, first_file), from one pass over each feed.
Tasks count their own records, so what is shuffled is one row a name. A name is a path:
``automobiles/automobile/vin``, ``speeding_tickets/officer_id``, ``people/id``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citewise.schemas import (
    AUTOMOBILE_COLUMNS,
    AUTOMOBILE_ROOT,
    AUTOMOBILE_ROW,
    PEOPLE_COLUMNS,
    SPEEDING_ARRAY,
    SPEEDING_COLUMNS,
)
from citewise.sources.automobiles import FILES as AUTOMOBILE_FILES
from citewise.sources.automobiles import automobile_records
from citewise.sources.bundle import bundle_members, list_archives, member_records
from citewise.sources.people import people_records
from citewise.sources.speeding import FILES as SPEEDING_FILES
from citewise.sources.speeding import speeding_records

# What stands in a record of XML and holds no tags.
_NO_TAGS = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"
_TAG = r"<([^\s/>!?][^\s/>]*)"

EXPECTED = {
    "people": {f"people/{name}" for name in PEOPLE_COLUMNS},
    "speeding": {f"{SPEEDING_ARRAY}/{name}" for name in SPEEDING_COLUMNS},
    "automobiles": {f"{AUTOMOBILE_ROOT}/{AUTOMOBILE_ROW}"}
    | {f"{AUTOMOBILE_ROOT}/{AUTOMOBILE_ROW}/{name}" for name in AUTOMOBILE_COLUMNS},
}
# In these feeds a name that is not expected is an error; the others may have more.
CLOSED = ("automobiles",)


class UnexpectedNameError(ValueError):
    """A feed's files use names that it may not have."""


def census_of_directories(
    spark: SparkSession,
    people_dir: str,
    speeding_dir: str,
    automobiles_dir: str,
    speeding_files: str = SPEEDING_FILES,
    automobile_files: str = AUTOMOBILE_FILES,
) -> DataFrame:
    """The names in the files of three folders."""
    return _census(
        {
            "people": people_records(spark, people_dir),
            "speeding": speeding_records(spark, speeding_dir, speeding_files),
            "automobiles": automobile_records(spark, automobiles_dir, automobile_files),
        }
    )


def census_of_members(members: DataFrame, tasks: int | None = None) -> DataFrame:
    """The names in the members of bundles, as ``bundle_members`` lists them."""
    records = {feed: member_records(members, feed, tasks) for feed in EXPECTED}
    return _census({feed: r.withColumn("file", F.concat_ws("!", "archive", "member")) for feed, r in records.items()})


def census_of_bundles(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """The names in all bundles of a folder."""
    return census_of_members(bundle_members(list_archives(spark, path)), tasks)


def require_expected(census: DataFrame) -> None:
    """Fails if a closed feed uses a name that it may not; tells the name and a file."""
    strange = census.where(~F.col("expected") & F.col("feed").isin(*CLOSED)).orderBy("feed", "name").limit(20).collect()
    if strange:
        told = ", ".join(f"{r['name']} ({r['records']} times, first in {r['first_file']})" for r in strange)
        raise UnexpectedNameError(f"names outside the expected ones: {told}")


def _census(records: dict[str, DataFrame]) -> DataFrame:
    """One row for each feed and name."""
    return reduce(DataFrame.unionByName, [_counted(feed, frame) for feed, frame in records.items()])


def _counted(feed: str, records: DataFrame) -> DataFrame:
    """Records are counted by the list of their names first: most of a file have the same."""
    found = records.select("file", _found(feed, F.col("record")).alias("_found"))
    named = found.select("file", _names(feed, F.col("_found")).alias("_names"))
    lists = named.groupBy("file", "_names").agg(F.count(F.lit(1)).alias("_records"))
    # An inner explode would filter empty lists at the source, and find all names there again.
    single = lists.select("file", "_records", F.explode_outer("_names").alias("name"))
    counts = single.where(F.col("name").isNotNull()).groupBy("name").agg(F.sum("_records").alias("records"), F.min("file").alias("first_file"))
    expected = F.col("name").isin(*sorted(EXPECTED[feed]))
    return counts.select(F.lit(feed).alias("feed"), "name", expected.alias("expected"), "records", "first_file")


def _found(feed: str, record: Column) -> Column:
    """The tags of a record, or its keys."""
    if feed == "automobiles":
        bare = F.when(record.rlike(r"<[!?]"), F.regexp_replace(record, _NO_TAGS, "")).otherwise(record)
        return F.regexp_extract_all(bare, F.lit(_TAG), F.lit(1))
    return F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))


def _names(feed: str, found: Column) -> Column:
    if feed == "automobiles":
        child = F.concat(F.lit(f"{AUTOMOBILE_ROOT}/"), F.element_at(found, 1))
        inner = F.array_distinct(F.slice(found, 2, F.size(found)))
        return F.concat(F.array(child), F.transform(inner, lambda tag: F.concat(child, F.lit("/"), tag)))
    lead = "people/" if feed == "people" else f"{SPEEDING_ARRAY}/"
    return F.transform(F.array_distinct(found), lambda key: F.concat(F.lit(lead), key))

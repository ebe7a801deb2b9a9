"""Zip bundles: the three feeds arriving together in one archive.

Archives are listed by path and never loaded as a value. Their members are spread
over the cluster, and each is streamed into records in bounded memory. A compressed
member can only be read from its start, so one member is one task; many members and
many archives are read side by side.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from typing import BinaryIO

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citewise.schemas import AUTOMOBILE_ROOT, AUTOMOBILE_ROW, PEOPLE_COLUMNS, SPEEDING_ARRAY
from citewise.sources.people import SEPARATOR
from citewise.sources.ranges import listed_bytes
from citewise.sources.records import (
    csv_records,
    json_records,
    member_lister,
    open_path,
    record_cutter,
    xml_records,
)

# The feed that each file extension carries.
FEED_OF_EXTENSION = {"csv": "people", "json": "speeding", "xml": "automobiles"}

_CUTTERS = {
    "people": partial(csv_records, separator=SEPARATOR, required=PEOPLE_COLUMNS),
    "speeding": partial(json_records, key=SPEEDING_ARRAY),
    "automobiles": partial(xml_records, tag=AUTOMOBILE_ROW, root_tag=AUTOMOBILE_ROOT),
}
_RESOURCE_FORKS = "__MACOSX/"

# Archives are known by their extension, in any case.
ARCHIVES = "*.[zZ][iI][pP]"

# What a task is given to cut, in inflated bytes, and how much members inflate by a
# guess; at the very least all cores are used.
TASK_BYTES = 128 * 1024 * 1024
INFLATED = 4

# The columns of Spark's binaryFile source, which a stream must be told.
_BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def list_archives(spark: SparkSession, path: str, pattern: str = ARCHIVES) -> DataFrame:
    """The archives of a folder. Only paths are read: the content column is pruned."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path")


def stream_archives(
    spark: SparkSession, path: str, pattern: str = ARCHIVES, archives_per_batch: int = 1000
) -> DataFrame:
    """The archives of a folder as they arrive."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", archives_per_batch)
        .load(path)
        .select("path")
    )


def bundle_members(
    archives: DataFrame, open_file: Callable[[str], BinaryIO] = open_path, depth: int = 1
) -> DataFrame:
    """(archive, member, member_bytes, extension, feed) for every file in the archives.

    The extension is compared in lower case. Files of another extension have no feed,
    nor, by default, files more than ``depth`` folders deep.
    """
    members = archives.mapInArrow(
        member_lister(open_file), "archive string, member string, member_bytes long"
    )
    extension = F.lower(F.regexp_extract("member", r"[^/]\.([^./]+)$", 1))
    folders = F.size(F.split("member", "/")) - 1
    return (
        members.where(~F.col("member").startswith(_RESOURCE_FORKS))
        .withColumn("extension", extension)
        .withColumn("feed", F.when(folders <= depth, _feed_of(F.col("extension"))))
    )


def rejected_members(
    archives: DataFrame, open_file: Callable[[str], BinaryIO] = open_path
) -> DataFrame:
    """The members that no feed takes. Files without an extension are not meant as data."""
    return rejected(bundle_members(archives, open_file))


def rejected(members: DataFrame) -> DataFrame:
    """The same out of a list of members."""
    return members.where(F.col("feed").isNull() & (F.col("extension") != ""))


def archive_bytes(spark: SparkSession, path: str, pattern: str = ARCHIVES) -> int:
    """The size of the archives of a folder, from the listing."""
    return listed_bytes(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path))


def tasks_for(spark: SparkSession, inflated: int) -> int:
    """How many tasks cut members of so many bytes."""
    return max(-(-inflated // TASK_BYTES), spark.sparkContext.defaultParallelism)


def bundle_records(
    archives: DataFrame,
    feed: str,
    tasks: int | None = None,
    open_file: Callable[[str], BinaryIO] = open_path,
) -> DataFrame:
    """(archive, member, record) for one feed: the text of every record."""
    return member_records(bundle_members(archives, open_file), feed, tasks, open_file)


def member_records(
    members: DataFrame,
    feed: str,
    tasks: int | None = None,
    open_file: Callable[[str], BinaryIO] = open_path,
) -> DataFrame:
    """(archive, member, record) for one feed, out of a list of members.

    The members are dealt to a given number of tasks by their size (see ``dealt``), since
    adaptive execution would judge them by the few bytes of their names and put them all
    into one. ``open_file`` opens a path as a seekable stream; pass your own for a file
    system that Arrow does not know.
    """
    wanted = members.where(F.col("feed") == feed).select("archive", "member", "member_bytes")
    tasks = tasks or members.sparkSession.sparkContext.defaultParallelism
    return dealt(wanted, "member_bytes", tasks).mapInArrow(
        record_cutter(open_file, _CUTTERS[feed]), "archive string, member string, record string"
    )


def dealt(rows: DataFrame, weight: str, tasks: int) -> DataFrame:
    """The rows in so many tasks, the heavy ones in turn, the longest first.

    Heavy rows weigh an eighth of a fair share or more, so there are eight for each task
    at most; they are numbered by weight, in one small sort, and go to the tasks there and
    back. The light ones are many or matter little, and go by a hash.
    """
    names = [c for c in rows.columns if c != weight]
    mean = rows.agg(F.sum(weight) / (8 * tasks)).scalar()
    spot = F.pmod(F.xxhash64(*names), F.lit(tasks))
    heavy = F.col(weight) >= mean
    order = Window.partitionBy(F.when(heavy, -1).otherwise(spot)).orderBy(F.desc(weight), *names)
    turn = F.row_number().over(order) - 1
    lap, at = F.floor(turn / tasks), F.pmod(turn, F.lit(tasks))
    there_and_back = F.when(lap % 2 == 0, at).otherwise(tasks - 1 - at)
    task = F.when(heavy, there_and_back).otherwise(spot).cast("int").alias("_task")
    return rows.select(*rows.columns, task).repartitionById(tasks, "_task").drop("_task")


def _feed_of(extension: Column) -> Column:
    feed = F.lit(None).cast("string")
    for name, target in FEED_OF_EXTENSION.items():
        feed = F.when(extension == name, target).otherwise(feed)
    return feed

"""Bundles that arrive one after the other, staged as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citewise.sinks.tables import write_feeds
from citewise.sinks.versions import Publisher, batch_version
from citewise.sources.bundle import bundle_members, rejected, stream_archives, tasks_for
from citewise.sources.load import feeds_from_members


class RejectedMemberError(ValueError):
    """Bundles hold files that no feed takes."""


def stage_arrivals(
    spark: SparkSession,
    bundles: str,
    staged: str,
    checkpoints: str,
    key_type: str = "bigint",
    archives_per_batch: int = 1000,
    tasks: int | None = None,
    fail_on_rejected: bool = False,
) -> list[StreamingQuery]:
    """Starts the query that stages all new bundles, then ends.

    Run it at any interval. Each batch lists its archives once, and commits the list of
    their members, the three feeds and the rejected members together, under the number
    of the batch; ``read_staged`` reads what is committed, and ``read_published`` the
    tables ``members`` and ``rejected``. The checkpoint remembers the archives that are
    done, and a batch that is repeated after a failure is committed once, so nothing is
    lost or doubled. With ``fail_on_rejected`` a batch with rejected members fails and
    stages nothing.
    """

    def stage(archives: DataFrame, batch: int) -> None:
        session = archives.sparkSession
        publisher = Publisher(session, staged, batch_version(session, checkpoints, batch), replaces=False)
        if publisher.done():
            return
        write_members(publisher, archives, key_type, tasks, fail_on_rejected)
        publisher.commit()

    return [
        stream_archives(spark, bundles, archives_per_batch=archives_per_batch)
        .writeStream.option("checkpointLocation", checkpoints)
        .foreachBatch(stage)
        .trigger(availableNow=True)
        .start()
    ]


def write_members(
    publisher: Publisher,
    archives: DataFrame,
    key_type: str = "bigint",
    tasks: int | None = None,
    fail_on_rejected: bool = False,
) -> dict[str, int]:
    """Writes members, rejected members and feeds of archives, which are listed once."""
    publisher.write("members", bundle_members(archives))
    members = publisher.read("members")
    refused = rejected(members)
    if fail_on_rejected:
        few = refused.orderBy("archive", "member").limit(20).collect()
        if few:
            raise RejectedMemberError("no feed takes " + ", ".join(f"{r['archive']}!{r['member']}" for r in few))
    publisher.write("rejected", refused)
    inflated = members.agg(F.coalesce(F.sum("member_bytes"), F.lit(0))).first()[0]
    return write_feeds(publisher, feeds_from_members(members, key_type, tasks or tasks_for(publisher.spark, inflated)))

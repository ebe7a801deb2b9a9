"""Month counts kept current while tickets arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citewise.functions.periods import month_of
from citewise.sinks.versions import batch_version, forget_versions, publish, read_published

COUNTS = "month_counts"


def month_counts_stream(
    tickets: DataFrame,
    time: str = "ticket_time",
    ticket: str = "id",
    lateness: str | None = None,
) -> DataFrame:
    """Tickets per month over a stream. The state is one count per month.

    With ``lateness``, months close: the month is truncated first and the watermark
    set on it, since Spark accepts no watermark on the raw time for groups this
    long. The delay counts from the start of the newest month seen, and tickets
    without a time are left out, for their group could never close. Use append
    mode then. Without it, use complete mode, which keeps every month open.
    """
    months = tickets.select(month_of(F.col(time)).alias("month"), F.col(ticket).alias("_ticket"))
    if lateness is not None:
        months = months.where(F.col("month").isNotNull()).withWatermark("month", lateness)
    return months.groupBy("month").agg(F.count("_ticket").alias("ticket_count"))


def write_latest(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps the newest complete table at ``path``; handles what is there, then ends.

    ``read_latest`` gives the table as it was last committed, also while it is replaced.
    A batch that is repeated writes nothing. The table before stays for its readers.
    """

    def replace(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        publish(session, {COUNTS: batch}, path, batch_version(session, checkpoint, number))
        forget_versions(session, path)

    return (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(replace)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    return read_published(spark, path, COUNTS)

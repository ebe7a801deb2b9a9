import pytest

from citewise.operators import month_counts
from citewise.schemas import speeding_schema
from citewise.streaming import month_counts_stream, read_latest, write_latest
from helpers import rows, ticket, tickets


@pytest.fixture
def arriving(spark, tmp_path):
    """Writes one file of tickets per call; the stream reads one file per batch."""
    folder = tmp_path / "tickets"

    def arrive(*times):
        frame = tickets(spark, *[ticket(f"{t}", time=t) for t in times]).coalesce(1)
        frame.write.mode("append").parquet(str(folder))

    def stream():
        reader = spark.readStream.schema(speeding_schema()).option("maxFilesPerTrigger", 1)
        return reader.parquet(str(folder))

    arrive.stream = stream
    arrive.batch = lambda: spark.read.parquet(str(folder))
    return arrive


def test_complete_table_equals_the_batch_answer(spark, tmp_path, arriving):
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for times in (["2020-12-01", "2021-01-31"], ["2020-12-31 23:59:59", None, "no time"]):
        arriving(*times)
        counts = month_counts_stream(arriving.stream())
        write_latest(counts, path, checkpoint).awaitTermination()
        assert rows(read_latest(spark, path)) == rows(month_counts(arriving.batch()))


def test_closed_months_are_emitted_and_open_ones_held(spark, tmp_path, arriving):
    for times in (
        ["2020-12-01"],
        ["2021-01-10", "2021-01-11"],
        ["2020-12-20", "2021-01-12"],
        ["2021-02-01", None],
    ):
        arriving(*times)
    counts = month_counts_stream(arriving.stream(), lateness="1 day")
    query = (
        counts.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    emitted = {r.month.month: r.ticket_count for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # February is open. The late December ticket came before December was closed.
    assert emitted == {12: 2, 1: 3}


def test_readers_keep_the_table_that_they_have(spark, tmp_path, arriving):
    """A table that was opened before the next one came is still there."""
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    arriving("2020-12-01")
    write_latest(month_counts_stream(arriving.stream()), path, checkpoint).awaitTermination()
    before, known = read_latest(spark, path), rows(read_latest(spark, path))
    arriving("2020-12-02")
    write_latest(month_counts_stream(arriving.stream()), path, checkpoint).awaitTermination()
    assert rows(before) == known
    assert [r[1] for r in rows(read_latest(spark, path))] == [2]


def test_a_stream_that_starts_anew_is_not_taken_for_a_repeat(spark, tmp_path, arriving):
    path = str(tmp_path / "out")
    arriving("2020-12-01")
    write_latest(month_counts_stream(arriving.stream()), path, str(tmp_path / "cp1")).awaitTermination()
    arriving("2020-12-02")
    write_latest(month_counts_stream(arriving.stream()), path, str(tmp_path / "cp2")).awaitTermination()
    assert [r[1] for r in rows(read_latest(spark, path))] == [2]

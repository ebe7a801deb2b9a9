import pytest

from citewise.plans import report_lines
from citewise.plans.report import officer_lines
from citewise.plans import run_report
from citewise.sinks import read_published, write_trends
from citewise.sources.load import Feeds
from citewise.plans import trend_tables
from helpers import automobiles, people, rows, ticket, tickets

TOP = "officer_id bigint, first_name string, last_name string, ticket_count bigint"


@pytest.fixture
def feeds(spark):
    return Feeds(
        people(
            spark,
            (1, "Zoe", "Z", "Police Officer"),
            (2, "Ann", "A", "Police Officer"),
            (3, "Bob", None, "Baker"),
        ),
        tickets(
            spark,
            ticket("a", 1, "2020-01-01 00:00:00", True, True, "P"),
            ticket("b", 2, "2020-02-01 00:00:00", True, False, "P"),
            ticket("c", 3, "2021-01-01 00:00:00", plate="Q"),
        ),
        automobiles(spark, ("3", "P"), ("1", "Q")),
    )


def test_lines(feeds):
    strict = Feeds(feeds.people, feeds.speeding.where("officer_id < 3"), feeds.automobiles)
    found = report_lines(strict).orderBy("question", "line_no").collect()
    assert [(r.question, r.line) for r in found] == [
        ("1", "Officer(s) Ann A,Zoe Z distributed the most speeding tickets: 1"),
        ("2", "These are the top three months by total tickets written"),
        ("2", "January 2020: 1 Tickets Written"),
        ("2", "February 2020: 1 Tickets Written"),
        ("3", "These are the top ten most ticketed drivers by total ticket dollars levied"),
        ("3", "Bob: $210"),
        ("4", "Tickets written per year and month, with the change since the one before"),
        ("4", "2020: 2 Tickets Written"),
        ("4", "2020-01: 1 Tickets Written"),
        ("4", "2020-02: 1 Tickets Written (+0)"),
    ]


def test_no_officer_at_the_top(spark):
    empty = spark.createDataFrame([], TOP)
    assert rows(officer_lines(empty), "line") == [
        ("Officer(s)  distributed the most speeding tickets: 0",)
    ]


def test_any_number_of_ties_shares_one_line(spark):
    for n in (2, 1500):
        top = spark.createDataFrame([(i, f"N{i:04}", "L", 5) for i in range(n)], TOP)
        names = ",".join(f"N{i:04} L" for i in range(n))
        assert rows(officer_lines(top), "line") == [
            (f"Officer(s) {names} distributed the most speeding tickets: 5",)
        ]


def test_trend_tables_are_written_in_order(spark, feeds, tmp_path):
    write_trends(*trend_tables(feeds.speeding), str(tmp_path))
    months = read_published(spark, str(tmp_path), "months").collect()
    assert [(r.month.year, r.month.month, r.ticket_count) for r in months] == [
        (2020, 1, 1),
        (2020, 2, 1),
        (2021, 1, 1),
    ]
    years = read_published(spark, str(tmp_path), "years").collect()
    assert [(r.year.year, r.ticket_count) for r in years] == [(2020, 2), (2021, 1)]


@pytest.fixture
def counted(spark, feeds):
    """The feeds, and how many ticket rows have been read so far."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return feeds._replace(speeding=feeds.speeding.mapInArrow(count, feeds.speeding.schema)), read


def test_the_report_reads_the_tickets_twice(counted):
    frames, read = counted
    report_lines(frames).collect()
    assert read.value == 2 * 3


def test_a_run_parses_the_tickets_once(spark, counted, tmp_path):
    frames, read = counted
    report = run_report(spark, frames, str(tmp_path), "r")
    assert read.value == 3
    lines = [r.value for r in spark.read.text(report).collect()]
    assert lines == [r.line for r in report_lines(frames).orderBy("question", "line_no", "line").collect()]
    assert rows(read_published(spark, str(tmp_path), "months", version="r"), "ticket_count") == [(1,), (1,), (1,)]
    # A run that is committed is not repeated.
    assert run_report(spark, frames, str(tmp_path), "r") == report

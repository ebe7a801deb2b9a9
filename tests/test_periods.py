import datetime as dt

from pyspark.sql import functions as F

from citewise.functions import month_key, month_label, month_of, year_of
from citewise.operators import (
    change_since_previous,
    month_counts,
    month_grid,
    month_rank_in_year,
    months_and_officers,
    seasonal_index,
    tickets_per_month_key,
    top_k_with_ties,
    year_counts,
    years_from_months,
)
from citewise.plans import top_months
from helpers import planned, rows, ticket, tickets

EDGES = ["2020-12-31 23:59:59", "2021-01-01 00:00:00", "not a time", None]


def at(*times):
    return [ticket(str(n), time=time) for n, time in enumerate(times)]


def month(year, number):
    return dt.datetime(year, number, 1)


def counts(spark, *pairs):
    return spark.createDataFrame(list(pairs), "month timestamp, ticket_count bigint")


def test_month_edges(spark):
    frame = tickets(spark, *at(*EDGES))
    time = F.col("ticket_time")
    assert rows(frame.select("id", month_key(time), month_of(time), year_of(time))) == [
        ("0", "202012", month(2020, 12), month(2020, 1)),
        ("1", "202101", month(2021, 1), month(2021, 1)),
        ("2", "not a t", None, None),
        ("3", None, None, None),
    ]


def test_null_time_is_a_group_of_its_own(spark):
    counted = {r.month: r.ticket_count for r in month_counts(tickets(spark, *at(*EDGES))).collect()}
    assert counted == {None: 2, month(2020, 12): 1, month(2021, 1): 1}


def test_both_month_keys_agree(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = tickets_per_month_key(lines, "l_shipdate", "l_linenumber")
    time = month_counts(lines, "l_shipdate", "l_linenumber").select(
        F.date_format("month", "yyyyMM"), "ticket_count"
    )
    assert rows(text) == rows(time)


def test_sums_agree(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    months = month_counts(lines, "l_shipdate", "l_linenumber")
    years = year_counts(lines, "l_shipdate", "l_linenumber")
    total = lines.count()
    for frame in (months, years):
        assert frame.agg(F.sum("ticket_count")).first()[0] == total
    assert rows(years_from_months(months)) == rows(years)
    shared = months_and_officers(lines, "l_suppkey", "l_shipdate", "l_linenumber")
    assert rows(shared.groupBy("kind").agg(F.sum("ticket_count"))) == [
        ("month", total),
        ("officer", total),
    ]
    assert rows(shared.where("kind = 'month'"), "month", "ticket_count") == rows(months)
    assert planned(shared).count("FileScan") == 1


def test_top_months_break_ties_by_month(spark):
    times = ["2020-03-01", "2020-03-02", "2021-01-01", "2020-02-01", "2022-01-01", "2020-12-01"]
    top = top_months(tickets(spark, *at(*times))).collect()
    assert [tuple(r) for r in top] == [("202003", 2), ("202002", 1), ("202012", 1)]


def test_top_k_with_ties(spark):
    frame = spark.createDataFrame(
        [("a", 9), ("b", 7), ("c", 7), ("d", 7), ("e", 1), ("f", None)], "k string, n int"
    )
    assert rows(top_k_with_ties(frame, "n", 1)) == [("a", 9)]
    assert rows(top_k_with_ties(frame, "n", 2)) == [("a", 9), ("b", 7), ("c", 7), ("d", 7)]
    assert len(rows(top_k_with_ties(frame, "n", 100))) == 5
    assert rows(top_k_with_ties(frame.where("false"), "n", 3)) == []
    assert "Window" not in planned(top_k_with_ties(frame, "n", 2))


def test_labels(spark):
    keys = spark.createDataFrame([("202012",), ("209913",), (None,), ("x",)], "k string")
    assert [r[0] for r in keys.select(month_label(F.col("k"))).collect()] == [
        "December 2020",
        "209913",
        "unknown month",
        "x",
    ]


def test_grid_fills_gaps(spark):
    sparse = counts(spark, (month(2020, 11), 4), (month(2021, 2), 5), (None, 9))
    assert rows(month_grid(sparse).orderBy("month")) == [
        (month(2020, 11), 4),
        (month(2020, 12), 0),
        (month(2021, 1), 0),
        (month(2021, 2), 5),
    ]
    assert rows(month_grid(sparse.where("false"))) == []


def test_change_rank_and_season(spark):
    frame = counts(
        spark, (month(2020, 1), 10), (month(2020, 2), 30), (month(2021, 1), 20), (None, 5)
    )
    assert [tuple(r) for r in change_since_previous(frame, "month").orderBy("month").collect()] == [
        (month(2020, 1), 10, None),
        (month(2020, 2), 30, 20),
        (month(2021, 1), 20, -10),
    ]
    assert rows(month_rank_in_year(frame), "year", "month", "month_rank") == [
        (2020, month(2020, 1), 2),
        (2020, month(2020, 2), 1),
        (2021, month(2021, 1), 1),
    ]
    assert rows(seasonal_index(frame)) == [(1, 0.75), (2, 1.5)]

import pytest
from pyspark.sql import functions as F

from citewise.functions import AS_CODED, PUBLISHED, fee_table, ticket_cost, with_fee_from_table
from helpers import planned, rows

FLAGS = [(False, False), (True, False), (False, True), (True, True), (None, True), (True, None), (None, None)]
EXPECTED = {
    PUBLISHED: [30, 60, 60, 120, 60, 60, 30],
    AS_CODED: [30, 90, 90, 120, 90, 90, 30],
}


@pytest.fixture
def flags(spark):
    return spark.createDataFrame(
        [(n, s, w) for n, (s, w) in enumerate(FLAGS)], "n int, school boolean, work boolean"
    )


@pytest.mark.parametrize("schedule", EXPECTED)
def test_truth_table(flags, schedule):
    cost = ticket_cost(F.col("school"), F.col("work"), schedule).alias("cost")
    priced = flags.select("n", cost)
    assert dict(priced.dtypes)["cost"] == "bigint"
    assert rows(priced) == list(enumerate(EXPECTED[schedule]))


@pytest.mark.parametrize("schedule", EXPECTED)
def test_lookup_gives_the_same(spark, flags, schedule):
    tickets = flags.withColumnsRenamed({"school": "s", "work": "w"})
    priced = with_fee_from_table(tickets, fee_table(spark, schedule), F.col("s"), F.col("w"))
    assert rows(priced, "n", "ticket_cost") == list(enumerate(EXPECTED[schedule]))


def test_missing_combination_keeps_the_ticket(spark, flags):
    fees = fee_table(spark, PUBLISHED).where("fee < 120")
    priced = with_fee_from_table(flags, fees, F.col("school"), F.col("work"))
    assert rows(priced.where("n = 3"), "ticket_cost") == [(None,)]


def test_lookup_is_broadcast_without_a_hint(spark, flags):
    priced = with_fee_from_table(
        flags.repartition(4), fee_table(spark, PUBLISHED), F.col("school"), F.col("work")
    )
    assert "BroadcastHashJoin" in planned(priced)

import random

import pytest
from pyspark.sql import functions as F

from citewise.functions import AS_CODED, PUBLISHED, ticket_cost
from citewise.operators import (
    Hot,
    estimate_hot,
    hot_keys,
    hot_weights,
    join_spread,
    join_with_unique,
    owner_totals,
    skew,
    ticket_vehicle_owner,
)
from citewise.plans import top_payers
from helpers import automobiles, people, planned, rows, table_scans, ticket, tickets

def fee():
    return ticket_cost(F.col("school_zone_ind"), F.col("work_zone_ind"), AS_CODED)



def person(id, first="F", last="L"):
    return (id, first, last, "Citizen")


def summed(frame):
    return frame.groupBy("person_id").agg(F.sum("ticket_cost").alias("total"))


def test_plate_on_two_vehicles_charges_twice(spark):
    autos = automobiles(spark, ("1", "P"), ("2", "P"))
    frame = tickets(spark, ticket("a", plate="P", school=True))
    folk = people(spark, person(1), person(2))
    assert rows(owner_totals(autos, frame, folk, fee())) == [(1, 90), (2, 90)]


def test_person_listed_twice_doubles_and_repeats(spark):
    autos = automobiles(spark, ("1", "P"), ("2", "Q"))
    frame = tickets(spark, ticket("a", plate="P"), ticket("b", plate="Q"))
    folk = people(spark, person(1, "Ann"), person(1, "Anne"), person(2, "Bob"))
    assert rows(owner_totals(autos, frame, folk, fee())) == [(1, 60), (2, 30)]
    assert [tuple(r) for r in top_payers(folk, frame, autos).collect()] == [
        (1, "Ann", "L", 60),
        (1, "Anne", "L", 60),
        (2, "Bob", "L", 30),
    ]
    assert [tuple(r) for r in top_payers(folk, frame, autos, k=1).collect()] == [(1, "Ann", "L", 60)]


def test_null_and_malformed_keys_match_nobody(spark):
    autos = automobiles(spark, (None, "P"), ("x7", "P"), ("1", None), ("1", "P"))
    frame = tickets(spark, ticket("a", plate="P"), ticket("b", plate=None))
    folk = people(spark, person(1), person(None))
    assert rows(owner_totals(autos, frame, folk, fee())) == [(1, 30)]
    assert rows(ticket_vehicle_owner(autos, frame, folk, fee())) == [(1, 30)]


def test_text_keys(spark):
    from citewise.schemas import people_schema

    folk = spark.createDataFrame([("u-1", "A", "B", "C")], people_schema("string"))
    autos = automobiles(spark, ("u-1", "P"))
    assert rows(owner_totals(autos, tickets(spark, ticket(plate="P")), folk, fee())) == [("u-1", 30)]


@pytest.mark.parametrize("hot_rows", [0, 1_000_000])
@pytest.mark.parametrize("seed", range(2))
def test_totals_equal_the_plain_joins(spark, monkeypatch, seed, hot_rows):
    """A third of all tickets, and of all vehicles, on one plate; repeated people."""
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(skew, "SKETCHED", 1.0)
    pick = random.Random(seed)
    plate = lambda: "HOT" if pick.random() < 1 / 3 else pick.choice([None, *"ABCDEFGH"])
    flag = lambda: pick.choice([True, False, None])
    autos = automobiles(spark, *[(str(pick.randint(0, 30)), plate()) for _ in range(120)])
    frame = tickets(
        spark, *[ticket(str(i), school=flag(), work=flag(), plate=plate()) for i in range(300)]
    )
    folk = people(spark, *[person(pick.randint(0, 30)) for _ in range(40)])
    plain = (
        autos.join(frame, "license_plate")
        .join(folk.withColumnRenamed("id", "owner"), F.col("owner") == F.col("person_id"))
        .select(F.col("owner").alias("person_id"), fee().alias("ticket_cost"))
    )
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    hot = estimate_hot(autos, frame, folk)
    assert bool(hot.plates) == bool(hot.ticketed) == (not hot_rows)
    expected = rows(summed(plain))
    assert expected
    for known in (Hot(), hot):
        detailed = ticket_vehicle_owner(autos, frame, folk, fee(), hot=known)
        assert rows(detailed) == rows(plain)
        assert rows(owner_totals(autos, frame, folk, fee(), hot=known)) == expected
        assert rows(owner_totals(autos, frame.repartition(7), folk.repartition(3), fee(), hot=known)) == expected


def test_ties_at_the_cut_go_by_id(spark):
    ids = list(range(1, 13))
    random.Random(1).shuffle(ids)
    folk = people(spark, *[person(i) for i in ids])
    autos = automobiles(spark, *[(str(i), f"P{i}") for i in ids])
    frame = tickets(
        spark, *[ticket(f"{i}", plate=f"P{i}", school=i > 8 and i < 12) for i in ids]
    )
    top = [r.person_id for r in top_payers(folk, frame, autos, PUBLISHED).collect()]
    assert top == [9, 10, 11, 1, 2, 3, 4, 5, 6, 7]


@pytest.fixture
def small_is_hot(monkeypatch):
    """Lets a few rows count as hot, so that small frames take the ways of large ones."""
    monkeypatch.setattr(skew, "HOT_ROWS", 0)
    monkeypatch.setattr(skew, "SKETCHED", 1.0)


def test_hot_keys_are_found_and_joined_by_broadcast(spark, small_is_hot):
    # 6,001 keys, one of which holds a third of the rows.
    vehicles = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    table = spark.range(9000).select(F.col("id").alias("t"), (F.col("id") * 2).alias("w"))
    assert hot_keys((vehicles, "k")) == [[0]]
    joined = join_with_unique(vehicles, "k", table, "t", hot_keys((vehicles, "k"))[0])
    assert joined.count() == 9000
    assert joined.where("w != k * 2").isEmpty()
    assert "Union" in planned(joined)


def test_evenly_spread_keys_are_not_hot(spark, small_is_hot):
    assert hot_keys((spark.range(50_000).withColumnRenamed("id", "k"), "k")) == [[]]


def test_every_hot_key_is_found_and_they_are_bounded(spark, small_is_hot):
    frame = spark.range(0, 90_000, 1, 8).select((F.col("id") % 900).alias("k"))
    assert sorted(hot_keys((frame, "k"))[0]) == list(range(900))


def test_a_sample_is_enough_to_find_a_third(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 10_000)
    frame = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    assert hot_keys((frame, "k")) == [["hot"]]


def test_few_rows_are_never_hot_and_the_plan_stays_plain(spark):
    vehicles = spark.range(9000).select(F.lit(0).alias("k"), "id")
    assert hot_keys((vehicles, "k")) == [[]]
    table = spark.range(5).withColumnRenamed("id", "t")
    plan = planned(join_with_unique(vehicles, "k", table, "t", hot_keys((vehicles, "k"))[0]))
    assert "Union" not in plan and plan.count("Join") == 1


@pytest.mark.parametrize("left_hot, right_hot", [(1, 0), (0, 1), (1, 1)])
def test_join_spread_deals_a_hot_key_out(spark, set_conf, small_is_hot, left_hot, right_hot):
    """A third of the rows of one side, or of both, share one key."""
    set_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="8",
    )

    def side(n, hot, names):
        key = F.when((F.col("id") % 3 == 0) if hot else F.lit(False), 0).otherwise(F.col("id"))
        return spark.range(n).select(key.alias(names[0]), F.col("id").alias(names[1]))

    left, right = side(3000, left_hot, ("k", "v")), side(1500, right_hot, ("t", "w"))
    hot = hot_keys((left, "k"), (right, "t"))
    assert hot == [[0] * left_hot, [0] * right_hot]
    joined = join_spread(left, "k", right, "t", *hot)
    plain = left.join(right, F.col("k") == F.col("t"))
    assert joined.count() == plain.count() > 1000
    assert joined.exceptAll(plain).isEmpty()
    hot = joined.where("k = 0").groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in hot.collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.6 * sum(sizes)


def test_no_tickets(spark):
    none, folk = tickets(spark), people(spark, person(1))
    autos = automobiles(spark, ("1", "P"))
    assert rows(owner_totals(autos, none, folk, fee())) == []
    assert rows(ticket_vehicle_owner(autos, none, folk, fee())) == []
    assert rows(top_payers(folk, none, autos)) == []


def test_parts_follow_the_rows_of_a_key(spark, set_conf, small_is_hot, monkeypatch):
    """Repeats don't grow with the number of shuffle partitions."""
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 250)
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(1500).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("t"), F.col("id").alias("w"))
    weights = hot_weights((left, "k"), (right, "t"))
    assert weights == [{0: 1000}, {0: 500}]
    assert skew._grid(*weights, 999) == {0: (4, 2)}
    for partitions in ("8", "64"):
        set_conf(spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__enabled="false")
        joined = join_spread(left, "k", right, "t", *weights)
        assert joined.count() == left.join(right, F.col("k") == F.col("t")).count()
    tasks = joined.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 6


def test_no_job_runs_while_a_query_is_built(spark):
    autos, frame, folk = automobiles(spark, ("1", "P")), tickets(spark, ticket(plate="P")), people(spark, person(1))
    spark.sparkContext.setJobGroup("building", "no job")
    ticket_vehicle_owner(autos, frame, folk, fee())
    owner_totals(autos, frame, folk, fee())
    top_payers(folk, frame, autos)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) == 0


def test_hot_plates_are_read_once(spark, sf):
    """Vehicles and tickets are scanned once each, with hot plates too."""
    from driver_tables.tables import OWNERSHIP, school, table, work

    orders, lineitem, customer = (table(spark, sf, n) for n in ("orders", "lineitem", "customer"))
    some = [r[0] for r in orders.select("o_orderkey").limit(3).collect()]
    hot = Hot(plates=dict.fromkeys(some, 5_000_000), ticketed=dict.fromkeys(some[:1], 2_000_000))
    cost = ticket_cost(school(), work(), AS_CODED)
    for operator in (owner_totals, ticket_vehicle_owner):
        plain = rows(operator(orders, lineitem, customer, cost, **OWNERSHIP))
        frame = operator(orders, lineitem, customer, cost, hot=hot, **OWNERSHIP)
        assert rows(frame) == plain
        assert {n: table_scans(frame)[n] for n in ("orders", "lineitem", "customer")} == {"orders": 1, "lineitem": 1, "customer": 1}

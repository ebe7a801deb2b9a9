"""The feeds that the queries write: whole documents, whatever the tasks hold."""

import pytest
from helpers import rows

from citewise.schemas import automobiles_schema, speeding_schema
from citewise.sources import read_automobiles, read_speeding
from driver_tables import feed_files

VEHICLES = [(str(n), f"<P&{n}", None, "a\n\"'>", "1999") for n in range(3)]


def in_last_task(spark, data, schema):
    """Three tasks, of which only the last one has rows."""
    return spark.createDataFrame(spark.sparkContext.parallelize([[], [], data], 3).flatMap(list), schema)


@pytest.mark.parametrize("data", [VEHICLES, []])
def test_vehicles_of_tasks_without_rows(spark, tmp_path, data):
    path = feed_files.write_automobiles(in_last_task(spark, data, automobiles_schema()), str(tmp_path / "x"))
    assert rows(read_automobiles(spark, path, files="*.txt")) == sorted(data, key=repr)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_tickets_of_tasks_without_rows(spark, tmp_path, n):
    data = [(f"{i}", i, None, i % 2 == 0, None, 'a"\n,') for i in range(n)]
    path = feed_files.write_speeding(in_last_task(spark, data, speeding_schema()), str(tmp_path / "s"))
    assert rows(read_speeding(spark, path, files="*.txt")) == sorted(data, key=repr)


def test_small_ranges_are_not_a_task_each(spark, tmp_path):
    data = [(f"{i}", i, None, True, None, "P") for i in range(2000)]
    path = feed_files.write_speeding(in_last_task(spark, data, speeding_schema()), str(tmp_path / "s"))
    read = read_speeding(spark, path, files="*.txt", range_bytes=1 << 9)
    assert rows(read) == sorted(data, key=repr)
    assert read.rdd.getNumPartitions() <= 2

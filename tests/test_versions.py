"""Tables that change all at once, rejected members, the census of names, placement."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from citewise.plans import run_bundles
from citewise.sinks import Publisher, forget_versions, publish, published, read_published, read_staged, stage_feeds
from citewise.sources import (
    UnexpectedNameError,
    bundle_members,
    bundle_records,
    census_of_bundles,
    census_of_directories,
    list_archives,
    load_bundles,
    require_expected,
)
from citewise.sources import bundle
from citewise.sources.load import EmptyFeedError, Feeds
from citewise.streaming import RejectedMemberError, stage_arrivals
from helpers import automobiles, people, rows, ticket, tickets, write, write_zip
from test_bundle import FULL, HEADER, autos_xml, cited, speeding_json

FAILURES = (PySparkException, Py4JJavaError)


@pytest.fixture
def numbers(spark):
    return lambda n: spark.range(n).withColumnRenamed("id", "n")


def test_a_version_is_seen_whole_or_not_at_all(spark, tmp_path, numbers, monkeypatch):
    path = str(tmp_path / "t")
    assert publish(spark, {"a": numbers(1), "b": numbers(2)}, path, "one")

    def dies(self):
        raise RuntimeError("the writer is gone")

    with monkeypatch.context() as patch:
        patch.setattr(Publisher, "commit", dies)
        with pytest.raises(RuntimeError):
            publish(spark, {"a": numbers(3), "b": numbers(4)}, path, "two")
    assert [read_published(spark, path, n).count() for n in "ab"] == [1, 2]
    # The next attempt starts anew.
    assert publish(spark, {"a": numbers(3), "b": numbers(4)}, path, "two")
    assert [read_published(spark, path, n).count() for n in "ab"] == [3, 4]


def test_a_version_is_written_once(spark, tmp_path, numbers):
    path = str(tmp_path / "t")
    assert publish(spark, {"a": numbers(1)}, path, "one")
    assert not publish(spark, {"a": numbers(9)}, path, "one")
    assert read_published(spark, path, "a").count() == 1


def test_versions_add_to_the_last_that_replaced(spark, tmp_path, numbers):
    path = str(tmp_path / "t")
    for name, n, replaces in (("x", 1, False), ("y", 10, True), ("z", 100, False), ("z2", 1000, False)):
        publish(spark, {"a": numbers(n)}, path, name, replaces)
    assert read_published(spark, path, "a").count() == 1110
    assert read_published(spark, path, "a", version="x").count() == 1
    assert published(spark, path, "b") == []
    assert read_published(spark, path, "b", numbers(1).schema).count() == 0
    with pytest.raises(FileNotFoundError):
        read_published(spark, path, "b")


def test_old_versions_go_and_their_names_stay_taken(spark, tmp_path, numbers):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        publish(spark, {"a": numbers(n)}, path, f"v{n}")
    forget_versions(spark, path)
    assert read_published(spark, path, "a").count() == 4
    assert read_published(spark, path, "a", version="v3").count() == 3
    assert len(list((tmp_path / "t" / "data").glob("*/a"))) == 2
    assert not publish(spark, {"a": numbers(9)}, path, "v1")


# ---- rejected members


ODD = {**FULL, "feeds/photo.jpg": "x", "d/e/deep.csv": HEADER, "README": ""}


def test_a_run_keeps_rejected_members(spark, tmp_path):
    folder, out = write_zip(tmp_path / "in", "a.zip", ODD), str(tmp_path / "out")
    report = run_bundles(spark, folder, out, "r1")
    assert "Bob B: $120" in [r.value for r in spark.read.text(report).collect()]
    refused = read_published(spark, out, "rejected", version="r1")
    assert rows(refused, "member") == [("d/e/deep.csv",), ("feeds/photo.jpg",)]
    assert read_published(spark, out, "members", version="r1").count() == 6
    with pytest.raises(RejectedMemberError, match="photo.jpg"):
        run_bundles(spark, folder, out, "r2", fail_on_rejected=True)
    assert published(spark, out, "members", "r2") == []
    with pytest.raises(EmptyFeedError, match="Automobiles"):
        run_bundles(spark, write_zip(tmp_path / "none", "a.zip", {**FULL, "feeds/autos.xml": autos_xml()}), out, "r3")


def test_arrivals_keep_rejected_members(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")

    def catch_up(**options):
        for arrival in stage_arrivals(spark, str(folder), f"{out}/staged", f"{out}/cp", tasks=2, **options):
            arrival.awaitTermination()

    write_zip(folder, "a.zip", ODD)
    catch_up()
    write_zip(folder, "b.zip", {"x.json": speeding_json(cited("t3")), "y.exe": ""})
    with pytest.raises(FAILURES, match="y.exe"):
        catch_up(fail_on_rejected=True)
    assert read_published(spark, f"{out}/staged", "speeding").count() == 2
    catch_up()
    assert rows(read_published(spark, f"{out}/staged", "rejected"), "member") == [("d/e/deep.csv",), ("feeds/photo.jpg",), ("y.exe",)]
    assert read_published(spark, f"{out}/staged", "speeding").count() == 3


def test_archives_are_listed_once_for_all_feeds(spark, tmp_path, monkeypatch):
    """The feeds of a run come from the list of members that it wrote."""
    from citewise.streaming import arrivals

    listed = []

    def listing(archives):
        listed.append(archives)
        return bundle_members(archives)

    monkeypatch.setattr(arrivals, "bundle_members", listing)
    run_bundles(spark, write_zip(tmp_path / "in", "a.zip", FULL), str(tmp_path / "out"), "r")
    assert len(listed) == 1


# ---- names


def test_census_of_folders(spark, tmp_path):
    write(tmp_path / "p", "a.csv", "id|first_name|last_name|profession|town\n1|A|B|C|D\n2|A|B|C|D\n")
    write(tmp_path / "s", "a.json", json.dumps({"speeding_tickets": [{"id": 1, "x": {"y": 2}}, None, {"id": 2}]}))
    autos = "<automobile><!-- <no> --><person_id a='b'>1</person_id><vin><![CDATA[<no>]]></vin></automobile><truck><vin/></truck>"
    write(tmp_path / "x", "a.xml", f"<automobiles>{autos}</automobiles>")
    write(tmp_path / "x", "b.xml", "<automobiles><truck/></automobiles>")
    census = census_of_directories(spark, *[str(tmp_path / n) for n in "psx"])
    found = {r["name"]: (r["feed"], r["expected"], r["records"], r["first_file"].rsplit("/", 1)[1]) for r in census.collect()}
    assert found == {
        **{f"people/{n}": ("people", True, 2, "a.csv") for n in ("id", "first_name", "last_name", "profession")},
        "people/town": ("people", False, 2, "a.csv"),
        "speeding_tickets/id": ("speeding", True, 2, "a.json"),
        "speeding_tickets/x": ("speeding", False, 1, "a.json"),
        "automobiles/automobile": ("automobiles", True, 1, "a.xml"),
        "automobiles/automobile/person_id": ("automobiles", True, 1, "a.xml"),
        "automobiles/automobile/vin": ("automobiles", True, 1, "a.xml"),
        "automobiles/truck": ("automobiles", False, 2, "a.xml"),
        "automobiles/truck/vin": ("automobiles", False, 1, "a.xml"),
    }
    with pytest.raises(UnexpectedNameError, match=r"automobiles/truck \(2 times, first in .*a.xml\)"):
        require_expected(census)
    require_expected(census.where("feed != 'automobiles'"))


def test_a_run_writes_the_names_and_stops_at_strange_ones(spark, tmp_path):
    out = str(tmp_path / "out")
    folder = write_zip(tmp_path / "in", "a.zip", FULL)
    run_bundles(spark, folder, out, "r1")
    names = read_published(spark, out, "names", version="r1")
    assert rows(names) == rows(census_of_bundles(spark, folder))
    assert names.where("not expected").isEmpty() and names.count() > 10
    strange = {**FULL, "feeds/autos.xml": autos_xml((1, "P1")).replace("</automobile>", "<wheels>4</wheels></automobile>")}
    with pytest.raises((*FAILURES, UnexpectedNameError), match="wheels|outside the expected"):
        run_bundles(spark, write_zip(tmp_path / "odd", "b.zip", strange), out, "r2")


# ---- placement


def test_members_are_dealt_by_their_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bundle, "TASK_BYTES", 4000)
    for n in range(6):
        sizes = [3000, 10, 20, 30] if n < 3 else [40, 50]
        members = {f"m{n}-{i}.csv": HEADER + f"{n}{i}|A|B|" + "x" * size + "\n" for i, size in enumerate(sizes)}
        folder = write_zip(tmp_path / "in", f"{n}.zip", members)
    archives = list_archives(spark, folder)
    for tasks in (3, 4, 7):
        records = bundle_records(archives, "people", tasks)
        assert records.rdd.getNumPartitions() == tasks
        placed = records.select("member", F.length("record").alias("n"), F.spark_partition_id().alias("task")).collect()
        assert len(placed) == 18
        largest = [r["task"] for r in placed if r["n"] > 3000]
        assert len(largest) == len(set(largest)) == 3
    inflated = bundle_members(archives).agg(F.sum("member_bytes")).first()[0]
    assert bundle.tasks_for(spark, inflated) == max(-(-inflated // 4000), 2)
    assert bundle.tasks_for(spark, 40_000) == 10
    assert load_bundles(spark, folder).people.rdd.getNumPartitions() >= 2


# ---- the gate


@pytest.mark.parametrize("empty, name", [(0, "People"), (1, "Speeding"), (2, "Automobiles")])
def test_staging_counts_rows_and_names_an_empty_feed(spark, tmp_path, empty, name):
    path = str(tmp_path / "staged")
    full = Feeds(people(spark, (1, "A", "B", "C")), tickets(spark, ticket()), automobiles(spark, ("1", "P")))
    field = Feeds._fields[empty]
    none = spark.createDataFrame([], getattr(full, field).schema)
    with pytest.raises(EmptyFeedError, match=f"{name} DataFrame is Empty!"):
        stage_feeds(full._replace(**{field: none}), path, "one", gate=True)
    assert [frame.count() for frame in read_staged(spark, path)] == [0, 0, 0]
    stage_feeds(full, path, "two", gate=True)
    assert [frame.count() for frame in read_staged(spark, path)] == [1, 1, 1]


def test_no_job_looks_for_empty_feeds_in_a_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", lambda self: pytest.fail("a job of its own"))
    run_bundles(spark, write_zip(tmp_path / "in", "a.zip", FULL), str(tmp_path / "out"), "r")

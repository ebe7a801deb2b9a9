import io
import json
from xml.etree import ElementTree

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from citewise.plans import run_report
from citewise.schemas import people_schema
from citewise.sinks import read_staged
from citewise.sources import bundle_members, census_of_bundles, list_archives, load_bundles, rejected_members
from citewise.sources.load import EmptyFeedError
from citewise.sources.records import csv_records, json_records, xml_records
from citewise.streaming import stage_arrivals
from driver_tables import feed_files
from helpers import planned, rows, write, write_zip

FAILURES = (PySparkException, Py4JJavaError)
HEADER = "id|first_name|last_name|profession\n"


def speeding_json(*tickets):
    return json.dumps({"speeding_tickets": list(tickets)})


def cited(id, officer=1, plate="P1", school=False):
    return {
        "id": id,
        "officer_id": officer,
        "ticket_time": "2020-01-05 10:00:00",
        "school_zone_ind": school,
        "work_zone_ind": False,
        "license_plate": plate,
    }


def autos_xml(*pairs):
    inner = "".join(
        f"<automobile><person_id>{owner}</person_id><license_plate>{plate}</license_plate></automobile>"
        for owner, plate in pairs
    )
    return f"<automobiles>{inner}</automobiles>"


FULL = {
    "feeds/people.csv": HEADER + "1|Ann|A|Police Officer\n2|Bob|B|Baker\n",
    "feeds/speeding.json": speeding_json(cited("t1"), None, cited("t2", school=True)),
    "feeds/autos.xml": autos_xml((2, "P1"), ("", "P2"), (2, "P3")),
    "__MACOSX/feeds/._people.csv": "junk",
}


def test_all_feeds(spark, tmp_path):
    folder = write_zip(tmp_path / "in", "a.zip", FULL)
    write_zip(
        tmp_path / "in",
        "b.zip",
        {"MORE.CSV": HEADER + "3|Cy|C|Baker\n", "x.json": speeding_json(cited("t3"))},
    )
    feeds = load_bundles(spark, folder)
    assert rows(feeds.people) == [
        (1, "Ann", "A", "Police Officer"),
        (2, "Bob", "B", "Baker"),
        (3, "Cy", "C", "Baker"),
    ]
    assert rows(feeds.speeding, "id", "school_zone_ind") == [
        ("t1", False),
        ("t2", True),
        ("t3", False),
    ]
    assert rows(feeds.automobiles, "person_id", "license_plate") == [("2", "P1"), ("2", "P3")]


def test_routing_and_rejection(spark, tmp_path):
    members = {
        "a.csv": "",
        "d/b.JSON": "",
        "d/c.txt": "",
        "d/e/deep.csv": "",
        "d/README": "",
        "d/.DS_Store": "",
        "__MACOSX/a.csv": "",
    }
    archives = list_archives(spark, write_zip(tmp_path / "in", "a.zip", members))
    routed = bundle_members(archives).where("feed IS NOT NULL")
    assert rows(routed, "member", "feed") == [("a.csv", "people"), ("d/b.JSON", "speeding")]
    assert rows(rejected_members(archives), "member") == [("d/c.txt",), ("d/e/deep.csv",)]


def test_archives_are_not_loaded_as_values(spark, tmp_path):
    folder = write_zip(tmp_path / "in", "a.zip", FULL)
    scan = planned(load_bundles(spark, folder).speeding)
    assert "ReadSchema: struct<path:string>" in scan


def test_paths_with_spaces(spark, tmp_path):
    folder = write_zip(tmp_path / "in coming%20", "a b.zip", FULL)
    assert load_bundles(spark, folder).people.count() == 2


def test_people_go_by_their_own_header(spark, tmp_path):
    """Other orders, more columns, line breaks in quotes; names of archives in any case."""
    wide = 'id|last_name|first_name|age|profession\n1|A|"Ann\n""x"""|7|Baker\n\n2|B|Bob||\n'
    folder = write_zip(tmp_path / "in", "a.ZIP", {"p.csv": wide})
    write_zip(tmp_path / "in", "b.zip", {"q.csv": HEADER + "3|Cy|C|Baker\n", "none.csv": ""})
    feeds = load_bundles(spark, folder, more_people=["age"])
    assert feeds.people.columns == ["id", "first_name", "last_name", "profession", "age"]
    assert rows(feeds.people) == [
        (1, 'Ann\n"x"', "A", "Baker", "7"),
        (2, "Bob", "B", None, None),
        (3, "Cy", "C", "Baker", None),
    ]
    assert load_bundles(spark, folder).people.columns == people_schema().names


@pytest.mark.parametrize("text", ["id|last_name\n1|A\n", HEADER + '1|"Ann|A|Baker\n'])
def test_a_lacking_column_and_an_open_quote_fail(spark, tmp_path, text):
    folder = write_zip(tmp_path / "in", "a.zip", {"p.csv": text})
    with pytest.raises(FAILURES, match="not in the header|unexpected end of data"):
        load_bundles(spark, folder).people.collect()


def test_element_beside_the_vehicles_fails(spark, tmp_path):
    text = autos_xml((1, "P1"), (3, "P3")).replace("<automobile>", "<truck/><automobile>", 1)
    folder = write_zip(tmp_path / "in", "a.zip", {"a.xml": text})
    with pytest.raises(FAILURES, match="truck"):
        load_bundles(spark, folder).automobiles.collect()


def test_unknown_element_fails(spark, tmp_path):
    text = "<automobiles><automobile><person_id>1</person_id><x>2</x></automobile></automobiles>"
    folder = write_zip(tmp_path / "in", "a.zip", {"a.xml": text})
    with pytest.raises(FAILURES, match="outside the expected columns"):
        load_bundles(spark, folder).automobiles.collect()


@pytest.mark.parametrize(
    "text", ['{"other": []}', speeding_json(cited("a"))[:-2], speeding_json(cited("a"))[:-9], ""]
)
def test_broken_json_fails(spark, tmp_path, text):
    folder = write_zip(tmp_path / "in", "a.zip", {"a.json": text})
    with pytest.raises(FAILURES):
        load_bundles(spark, folder).speeding.collect()


@pytest.mark.parametrize("chunk", [1, 2, 7, 1 << 20])
def test_json_is_cut_exactly_at_any_chunk_size(chunk):
    elements = [{"a": 'x}],"\\', "b": {"c": [1, 2]}}, None, 12, {"ü": "}"}]
    document = json.dumps({"meta": {"n": [1]}, "t": elements, "z": 5}, indent=1)
    found = list(json_records(io.BytesIO(document.encode()), "t", chunk))
    assert [json.loads(text) for text in found] == elements
    assert list(json_records(io.BytesIO(b' {"t" : [ ] } '), "t", chunk)) == []
    for broken in (b'{"t": [1 2]}', b'{"t": [1,]}', b'{"t": [1]', b'{"t": [1]} x', b"{}", b"[1]"):
        with pytest.raises(ValueError):
            list(json_records(io.BytesIO(broken), "t", chunk))


values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False) | st.text(),
    lambda inner: st.lists(inner) | st.dictionaries(st.text(), inner),
    max_leaves=20,
)


@given(st.lists(values), st.integers(1, 40), st.sampled_from([None, 1]))
@settings(deadline=None)
def test_any_json_is_cut_exactly(elements, chunk, indent):
    document = json.dumps({"before": elements, "t": elements, "z": {}}, indent=indent)
    found = json_records(io.BytesIO(document.encode()), "t", chunk)
    assert [json.loads(text) for text in found] == elements


def test_xml_and_csv_are_cut():
    text = b"<r><a><b>1 &amp; 2</b></a> <!-- </a> --> <a><![CDATA[<a>]]></a><a/></r>"
    assert list(xml_records(io.BytesIO(text), "a")) == [
        "<a><b>1 &amp; 2</b></a>",
        "<a>&lt;a&gt;</a>",
        "<a />",
    ]
    records = csv_records(io.BytesIO(b"\xef\xbb\xbfh|i\r\n1|\n\n2|b"))
    assert [json.loads(r) for r in records] == [{"h": "1", "i": None}, {"h": "2", "i": "b"}]


def test_run_from_bundle_to_report(spark, tmp_path):
    folder = write_zip(tmp_path / "in", "a.zip", FULL)
    for _ in range(2):  # a run that is repeated leaves the same behind
        report = run_report(spark, load_bundles(spark, folder), str(tmp_path / "out"), "r1")
        lines = [r.value for r in spark.read.text(report).collect()]
        assert lines == [
            "Officer(s) Ann A distributed the most speeding tickets: 2",
            "These are the top three months by total tickets written",
            "January 2020: 2 Tickets Written",
            "These are the top ten most ticketed drivers by total ticket dollars levied",
            "Bob B: $120",
            "Tickets written per year and month, with the change since the one before",
            "2020: 2 Tickets Written",
            "2020-01: 2 Tickets Written",
        ]
    assert report.endswith("run_id=r1")


def test_run_with_an_empty_feed_fails(spark, tmp_path):
    folder = write_zip(tmp_path / "in", "a.zip", {**FULL, "feeds/autos.xml": autos_xml()})
    with pytest.raises(EmptyFeedError, match="Automobiles"):
        run_report(spark, load_bundles(spark, folder), str(tmp_path / "out"), "r1")


def test_arrivals_are_staged_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")

    def catch_up():
        for arrival in stage_arrivals(spark, str(folder), f"{out}/staged", f"{out}/cp", tasks=2):
            arrival.awaitTermination()
        return read_staged(spark, f"{out}/staged")

    write_zip(folder, "a.zip", FULL)
    assert rows(catch_up().speeding, "id", "ticket_year") == [("t1", 2020), ("t2", 2020)]
    write_zip(folder, "b.zip", {"x.json": speeding_json(cited("t3"))})
    feeds = catch_up()
    assert rows(feeds.speeding, "id") == [("t1",), ("t2",), ("t3",)]
    batch = load_bundles(spark, str(folder))
    for name in ("people", "automobiles"):
        assert rows(getattr(feeds, name)) == rows(getattr(batch, name))
    assert feeds.people.schema.names == people_schema().names
    assert rows(catch_up().speeding, "id") == [("t1",), ("t2",), ("t3",)]


def parsed_records(text):
    """The children of a document's root, as a parser gives them."""
    children = list(ElementTree.fromstring(text))
    for child in children:
        child.tail = None
    return [ElementTree.canonicalize(ElementTree.tostring(child, encoding="unicode")) for child in children]


XML_BODIES = [
    "<a><b>1</b>\n <c>é</c></a>\n<a><b>2</b></a>",
    "<a></a><a/><a> </a><a x='1'><b>1</b></a><a><b>3</b></a>",
    "<a><b>1</b></a><!-- <a><b>no</b></a> --><a><b>2</b></a><?p <a><b>no</b></a>?><a><b>3</b></a>",
    "<a><b>1</b></a><a><b><![CDATA[<a><b>no</b></a>]]></b></a><a><b>2</b></a>",
    "<a><a><b>inner</b></a></a><a><b>&amp;&#65;</b><b/><b>]</b></a><a><b>2</b></a>",
    "text <a><b>1</b></a> text <a><b>2</b> text</a><a><b>3\r\n</b></a>",
]


@pytest.mark.parametrize("chunk", [1, 7, 40, 1 << 20])
@pytest.mark.parametrize("body", XML_BODIES)
def test_xml_is_cut_as_it_is_parsed(body, chunk):
    text = f"<?xml version='1.0'?>\n<r>{body}</r>\n".encode()
    found = [ElementTree.canonicalize(record) for record in xml_records(io.BytesIO(text), "a", "r", chunk)]
    assert found == parsed_records(text)


BROKEN_BODIES = ["<a><b>1</a></b>", "<a><b>\x01</b></a>", "<a><b>]]></b></a>", "<a><b>1</b></a><c/>", "<a><b>1</b></a></r><r>", "<a><b>1</b>"]


@pytest.mark.parametrize("chunk", [7, 1 << 20])
@pytest.mark.parametrize("body", BROKEN_BODIES)
def test_broken_xml_is_not_cut(body, chunk):
    with pytest.raises((ValueError, ElementTree.ParseError)):
        list(xml_records(io.BytesIO(f"<r><a><b>0</b></a>{body}</r>".encode()), "a", "r", chunk))


def test_xml_of_other_encodings_and_namespaces():
    latin = "<?xml version='1.0' encoding='latin-1'?><r><a><b>é</b></a></r>".encode("latin-1")
    assert list(xml_records(io.BytesIO(latin), "a", "r")) == ["<a><b>é</b></a>"]
    wide = "<?xml version='1.0' encoding='utf-16'?><r><a><b>é</b></a><a/></r>".encode("utf-16")
    assert list(xml_records(io.BytesIO(wide), "a", "r")) == ["<a><b>é</b></a>", "<a />"]
    with pytest.raises(ValueError):
        list(xml_records(io.BytesIO(b"<r xmlns='u'><a><b>1</b></a></r>"), "a"))
    with pytest.raises(ElementTree.ParseError):
        list(xml_records(io.BytesIO(b""), "a"))


def test_flat_records_are_not_parsed_one_by_one(monkeypatch):
    fed = []

    class Parser(ElementTree.XMLPullParser):
        def feed(self, data):
            fed.append(len(data))
            super().feed(data)

    monkeypatch.setattr(ElementTree, "XMLPullParser", Parser)
    text = b"<r>" + b"<a><b>1</b></a>" * 10_000 + b"</r>"
    assert len(list(xml_records(io.BytesIO(text), "a", "r"))) == 10_000
    assert sum(fed) < 100


def test_archives_are_packed_by_many_tasks(spark, tmp_path):
    for n in range(8):
        write(tmp_path / "feeds" / "people", f"part-{n:05d}-x.csv", HEADER + f"{n}|A|B|C\n")
    bundles = feed_files.write_bundles(spark, f"file://{tmp_path}/feeds")
    assert len(list((tmp_path / "feeds" / "bundles").glob("*.zip"))) == 8
    written = spark.read.parquet(f"{tmp_path}/feeds-manifest")
    assert len(written.inputFiles()) == spark.sparkContext.defaultParallelism
    assert rows(load_bundles(spark, bundles).people, "id") == [(n,) for n in range(8)]


def test_names_are_counted_by_lists(spark, tmp_path):
    documents = {
        "f/a.xml": "<automobiles><automobile><vin>1</vin><vin>2</vin><!-- <no/> --></automobile><automobile/></automobiles>",
        "f/b.xml": "<automobiles><automobile><vin>3</vin><tow/></automobile></automobiles>",
        "f/a.json": speeding_json({"id": 1, "note": None}, {"id": 2}),
    }
    census = census_of_bundles(spark, write_zip(tmp_path, "b.zip", documents))
    assert rows(census, "feed", "name", "expected", "records") == [
        ("automobiles", "automobiles/automobile", True, 3),
        ("automobiles", "automobiles/automobile/tow", False, 1),
        ("automobiles", "automobiles/automobile/vin", True, 2),
        ("speeding", "speeding_tickets/id", True, 2),
        ("speeding", "speeding_tickets/note", False, 1),
    ]


def test_the_census_sorts_no_records(spark, tmp_path):
    folder = write_zip(tmp_path, "b.zip", {"f/a.json": speeding_json({"id": 1})})
    plan = planned(census_of_bundles(spark, folder))
    # Below the counts by list, the first aggregates of a feed's records, nothing is sorted.
    for part in plan.split("HashAggregate(keys=[file")[1:]:
        assert "SortAggregate" not in part.split("MapInArrow")[0]
    assert "HashAggregate(keys=[file" in plan
    # Names are found once, not for a filter, too.
    assert not [line for line in plan.splitlines() if "Filter" in line and ("json_object_keys" in line or "regexp_extract_all" in line)]

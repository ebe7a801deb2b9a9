"""The pipeline: its stages in order, on few rows and on the small tables."""

import pytest

import corpus_pipeline
from citewise.llm import queries


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage leaves of the smallest tables."""
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        folder = corpus_pipeline.new_folder(spark, name)
        stage(spark, out[-1], sf).write.parquet(folder)
        out.append(spark.read.parquet(folder))
    return out


def ids(frame):
    return sorted(r[0] for r in frame.select("doc_id").distinct().collect())


def test_stages_keep_the_columns_of_documents(stages):
    assert all(s.schema == stages[0].schema for s in stages[1:-1])
    assert all(set(ids(after)) <= set(ids(before)) for before, after in zip(stages, stages[1:]))


def test_exact_and_near_copies_go_and_the_rest_stays(stages):
    toxic, exact, near = stages[1:4]
    groups = {}
    for r in toxic.collect():
        key = " ".join((r["text"] or "").replace("\t", " ").split(" "))
        groups[key] = min(r["doc_id"], groups.get(key, r["doc_id"]))
    kept = {r["text"] for r in exact.collect()}
    assert len(ids(exact)) <= len(ids(toxic)) and set(ids(exact)) <= set(groups.values())
    assert len(kept) == len(ids(exact)) >= len(ids(near)) > 0


def test_personal_data_is_gone_and_nothing_else(stages):
    before = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    after = {r["doc_id"]: r for r in stages[4].collect()}
    assert set(before) == set(after)
    for i, row in after.items():
        assert (row["text"] is None) == (before[i] is None)
        assert row["text"] is None or row["n_chars"] == len(row["text"])
        if before[i] and "<" not in (row["text"] or ""):
            assert row["text"] == before[i]


def test_run_is_its_stages(spark, stages):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert ids(found) == ids(stages[4])
    assert found.columns == stages[5].columns
    columns = [c for c in found.columns if c not in ("sequence_id", "offset")]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, stages[5].select(columns).collect()))

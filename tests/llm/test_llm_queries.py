"""Whole queries against plain Python, and what the operators' parts promise."""

import hashlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from citewise.llm import exact_dedup, near_dedup, pii, queries, sentencepieces, token_counts, topk, toxicity, url_filter
from test_llm_operators import best_cut, by_id, documents, family, plain_classes, runs_of, words_of

SF = "/root/testdata/sf0.01"


def test_sentencepiece_query_against_the_library(spark, sf):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    found = by_id(queries.op6_sentencepiece(spark, sf))
    texts = documents(spark, sf)
    assert set(found) == set(texts)
    for i, text in texts.items():
        ids = library.encode(text, add_bos=False, add_eos=True)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def all_links(texts):
    """Every pair of at least 0.8, by an index of the word runs."""
    runs = {i: runs_of(t) for i, t in texts.items()}
    holders, both = defaultdict(list), Counter()
    for i, own in runs.items():
        for run, n in own.items():
            for repeat in range(n):
                holders[run, repeat].append(i)
    for ids in holders.values():
        both.update(combinations(sorted(ids), 2))
    total = {i: sum(own.values()) for i, own in runs.items()}
    return [(a, b) for (a, b), n in both.items() if n / (total[a] + total[b] - n) >= 0.8]


def test_near_dedup_query_against_all_pairs(spark):
    texts = documents(spark, SF)
    found = by_id(queries.op10_near_dedup(spark, SF))
    assert set(found) == set(texts)
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = all_links(texts)
    caught = [found[a]["class_id"] == found[b]["class_id"] for a, b in links]
    assert len(links) > 50 and sum(caught) >= 0.99 * len(links)
    same = defaultdict(list)
    for i, text in texts.items():
        same[tuple(words_of(text))].append(i)
    for a, b in links + [(ids[0], i) for ids in same.values() for i in ids[1:]]:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    # Nothing is in a class without a chain of links to it.
    members = defaultdict(set)
    for i, r in found.items():
        members[r["class_id"]].add(find(i))
    assert all(len(roots) == 1 for roots in members.values())


@pytest.mark.parametrize("block", [600, 4000])
def test_near_dedup_in_blocks_against_all_pairs(spark, monkeypatch, block):
    """Hubs give up at once, and buckets are many blocks."""
    monkeypatch.setattr(near_dedup, "HUB_SHARE", 0.0)
    monkeypatch.setattr(near_dedup, "BLOCK_RUNS", block)
    monkeypatch.setattr(near_dedup, "LEAST_RUNS", 10)
    rng = np.random.default_rng(block)
    texts = [t for size, changes in ((50, 5), (30, 8), (20, 2), (1, 1)) for t in family(rng, size, changes=changes)]
    texts += [texts[0], "one two three four five six " * 30, "one two three four five six " * 31]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = by_id(near_dedup.classes(frame), "id")
    assert {i: r["class_id"] for i, r in found.items()} == plain_classes(dict(enumerate(texts)))


def test_overlaps_against_sets(monkeypatch):
    monkeypatch.setattr(near_dedup, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    one, two = ([np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in rng.integers(0, 50, size)] for size in (9, 12))
    found = near_dedup.overlaps(one, two)
    assert [[len(set(a.tolist()) & set(b.tolist())) for b in two] for a in one] == found.tolist()
    assert near_dedup.overlaps(one, [np.zeros(0, np.uint64)]).tolist() == [[0]] * 9


def test_spanning_links_join_what_all_links_join():
    rng = np.random.default_rng(3)
    for _ in range(50):
        comps = [bytes([c]) for c in rng.integers(0, 12, 30)]
        first, second = np.arange(12), np.arange(12, 30)
        linked = rng.random((12, 18)) < 0.1
        chosen = near_dedup.spanning(comps, linked, first, second)

        def parts(pairs):
            root = {c: c for c in comps}
            find = lambda c: c if root[c] == c else find(root[c])
            for i, j in pairs:
                root[find(comps[i])] = find(comps[j])
            return Counter(frozenset(c for c in root if find(c) == find(d)) for d in root)

        every = [(i, j) for i in first for j in second if linked[i, j - 12]]
        assert set(chosen) <= set(every) and len(chosen) < len(set(comps))
        assert parts(chosen) == parts(every)


# Toxicity


def votes_of(rng, truth, accuracy, coverage):
    votes = np.where(rng.random(len(truth)) < accuracy, truth, -truth)
    return np.where(rng.random(len(truth)) < coverage, votes, 0)


def test_label_model_finds_accuracies_and_copies_without_labels():
    rng = np.random.default_rng(7)
    truth = np.where(rng.random(6000) < 0.4, 1, -1)
    known = [(0.9, 0.8), (0.8, 0.9), (0.7, 0.7), (0.85, 0.5), (0.75, 0.9)]
    votes = np.stack([votes_of(rng, truth, a, c) for a, c in known], 1)
    copies = np.concatenate([votes, votes[:, 2:3]], 1)
    model = toxicity.LabelModel.fit(copies)
    for v, (accuracy, coverage) in enumerate(known):
        for y, right in ((0, 0), (1, 2)):
            assert abs(model.rates[y, v, right] - accuracy * coverage) < 0.08
    # The two that are one voter weigh about as much as one.
    others = model.weight[[0, 1, 3, 4]]
    assert model.weight[2] + model.weight[5] < 1.4 * others.mean()
    said = model.posterior(copies) > 0.5
    assert (said == (truth > 0)).mean() > (votes[:, 2] == truth).mean() + 0.2


def test_toxicity_of_long_texts_and_repeated_ids(spark):
    rng, long = np.random.default_rng(5), "fine words here " * 40_000
    kinds = [["nice", "kind", "lovely", "gentle", "sweet", "friendly"], ["awful", "rotten", "vile", "nasty", "filthy", "horrid"]]
    rows = [(i, " ".join([*rng.choice(kinds[i % 2], 3), f"text{i} w{i * 7} z{i * 11}"]) + " " + (long if i < 2 else "")) for i in range(300)]
    rows += [(5, "another text of one id"), (5, "and another")] + [(400 + i, None) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(5, 0), (6, 7), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model, ["doc_id"], name="doubt").collect()
    assert len(scored) == len(rows)
    found = {r["doc_id"]: r["doubt"] for r in scored if r["doc_id"] != 5}
    right = [(found[i] >= 0.5) == (i % 2 == 1) for i in range(300) if i != 5]
    assert sum(right) >= 0.97 * len(right)


# Pipeline


@pytest.fixture
def tables(spark, tmp_path):
    """The smallest tables with odd documents, whose columns have names that stages use."""

    def write(documents):
        labels = queries.table(spark, "/root/testdata/sf0.001", "labels")
        labels.write.parquet(str(tmp_path / "labels.parquet"))
        documents.write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return write


CLASHING = {"score": "x", "file": "f", "row": "r", "clean": "c", "_row": "y", "_file": "z", "keep": "k", "node": "n", "id": "i", "at": "a"}


def test_pipeline_on_odd_rows_and_clashing_columns(spark, tables):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    odd = [(None, None), (9001, None), (9002, ""), (9003, "mail a.b@c-d.org now"), (9003, "mail a.b@c-d.org now"), (None, "alone"), (9004, "word " * 20_000)]
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], docs.schema)
    wide = docs.unionByName(odd).withColumns({c: F.lit(v) for c, v in CLASHING.items()})
    sf = tables(wide)
    kept = spark.read.parquet(sf + "/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        folder = corpus_pipeline.new_folder(spark, name)
        stage(spark, kept, sf).write.parquet(folder)
        after = spark.read.parquet(folder)
        assert after.columns == wide.columns
        kept = after
    left = {(r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect()}
    assert (9003, "mail <EMAIL> now") in left and (None, "alone") in left
    assert len([r for r in left if not r[1]]) == 1
    packed = corpus_pipeline.run(spark, sf)
    assert packed.select("doc_id").distinct().count() == len({i for i, _ in left})


def test_pipeline_on_no_rows(spark, tables):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents").where("false")
    assert corpus_pipeline.run(spark, tables(docs)).count() == 0


# Personal data: the field by itself


@pytest.fixture(scope="module")
def field():
    return pii.train(pii.labelled_examples())


PLANTED = {
    "email": ["anna.b_c@some.example.org", "x9@y.co.uk", "<joe-z@mail.net>", "lea(at)firm.com", "tim.k[at]place.org"],
    "ip": ["10.20.30.40", "(192.168.1.255", "8.8.4.4,"],
    "card": ["4111 1111 1111 1111", "5500-0000-0000-0004.", "4012888888881881", "3782 822463 10005"],
    "phone": ["+1 (212) 555-0123", "(030) 123-4567", "212-555-0199.", "+49 170 1234567", "415.555.2671", "+442079460958"],
}


def test_the_field_alone_finds_what_is_planted(field, monkeypatch):
    monkeypatch.setattr(pii, "base_spans", lambda text: {k: [] for k in pii.KINDS})
    finder = pii.Finder(field)
    rng, caught, n = np.random.default_rng(2), 0, 0
    texts = [t for t in documents_text() if t]
    for kind, items in PLANTED.items():
        for item in items:
            for _ in range(6):
                words = texts[rng.integers(len(texts))].split()
                at = rng.integers(len(words))
                left, right = " ".join(words[max(0, at - 9) : at]), " ".join(words[at : at + 9])
                _, spans = finder([f"{left} {item} {right}"])[0]
                core = item.strip("<>(),. ")
                n += 1
                caught += any(core[2:-2] in f"{left} {item} {right}"[a:b] for a, b in spans[kind])
    assert caught >= 0.9 * n


def documents_text():
    import duckdb

    return [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()]


def test_the_field_leaves_plain_words_alone(field, monkeypatch):
    """Labels before any bound: fewer than one in ten thousand words."""
    runs = []
    monkeypatch.setattr(pii, "valid", lambda kind, text: runs.append((kind, text)) or False)
    texts = [t or "" for t in documents_text()]
    pii.Finder(field)(texts)
    # Numbers of the size of a card are no plain words, whatever their checksum.
    wrong = [text for kind, text in runs if not (kind == "card" and 15 <= len(pii.digits_of(text)) <= 19)]
    assert len(wrong) < sum(len(t.split()) for t in texts) / 10_000


def test_the_field_adds_what_patterns_miss(spark, field):
    texts = ["Call (212) 555-0123 or 212-555-0199 today.", "Write lea.m(at)firm.com, please.", "Pay 3782 822463 10005 now.", "On 2020-01-02 at 10:30:15 v1.2.3 cost $123.45."]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = by_id(pii.find(frame, field, ["doc_id"]))
    spans = {i: [(k, texts[i][int(a) : int(b)]) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)] for i, r in found.items()}
    assert spans[0] == [("phone", "(212) 555-0123"), ("phone", "212-555-0199")]
    assert spans[1] == [("email", "lea.m(at)firm.com")] and spans[2] == [("card", "3782 822463 10005")] and spans[3] == []
    assert all(r["n_email"] + r["n_phone"] + r["n_card"] + r["n_ip"] == 0 for r in found.values())
    assert pii.train([]).index == {} and by_id(pii.find(frame, pii.train([]), ["doc_id"]))[0]["spans"] == ""


# Identifiers, long urls, documents without an id


def test_top_k_keeps_large_identifiers_and_leaves_nameless_rows_out(spark):
    big = 2**60
    rows = [(big, [1.0, 0.0]), (big + 1, [2.0, 0.0]), (big + 1, [3.0, 0.0]), (None, [9.0, 9.0]), (7, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(topk.whole_vectors(frame, "vec_id", "embedding"), F.col("id") == big, 5).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [big + 1, big + 1, 7]
    assert [r["score"] for r in found] == [64 * 192, 64 * 128, 0]


def test_long_urls_cost_no_more(spark):
    long_host = "a." * 20_000 + "b.com"
    urls = ["x://" + long_host + "/de/" + "p" * 50_000, "x://" + "y" * 50_000, "x://c.example.org/es/"]
    host, path = url_filter.url_parts(F.col("url"))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").select("page_id", host.alias("host"), path.alias("path"))
    rules = spark.createDataFrame([*queries.RULES, ("b.com", "/de/p", "allow"), ("b.com", "/de/p", "block")], "host string, path string, verdict string")
    found = by_id(url_filter.match(pages, rules, ["page_id"], "host", "path"), "page_id")
    assert [(found[i]["entry"], found[i]["verdict"]) for i in range(3)] == [("b.com/de/p", "block"), (None, None), ("example.org/es/", "block")]


def test_documents_without_an_id_are_not_held_out(spark, sf, tables):
    docs = queries.table(spark, sf, "documents")
    extra = spark.createDataFrame([(None, "the text of no one", "xx", None, None)], docs.schema)
    folder = tables(docs.unionByName(extra))
    for name in ("op4_language", "op8_toxicity"):
        mine = [r for r in queries.QUERIES[name](spark, folder).collect() if r["doc_id"] is None]
        assert [r["held_out"] for r in mine] == [False]
    assert "xx" not in {r["lang_pred"] for r in queries.op4_language(spark, folder).collect()}


# Exact dedup as a stream


def test_later_arrivals_meet_earlier_ones(spark, tmp_path, monkeypatch):
    state = str(tmp_path / "state")
    first = spark.createDataFrame([(10, "a b"), (11, "c"), (None, "d"), (12, "a  b")], "doc_id long, text string")
    first.coalesce(1).write.parquet(str(tmp_path / "one"))
    found = by_id(exact_dedup.assign(spark.read.parquet(str(tmp_path / "one")), in_files=True, state_folder=state), "id")
    assert {i: (r["keep"], r["group_size"], r["kept"]) for i, r in found.items()} == {
        10: (10, 2, True), 12: (10, 2, False), 11: (11, 1, True), None: (None, 1, True)
    }
    second = spark.createDataFrame([(20, "a\tb"), (5, "c"), (21, "new"), (22, "d"), (22, "d")], "doc_id long, text string")
    found = exact_dedup.assign(second, state_folder=state).collect()
    assert sorted((r["id"], r["keep"], r["group_size"], r["kept"]) for r in found) == [
        (5, 5, 2, True), (20, 10, 3, False), (21, 21, 1, True), (22, 22, 3, False), (22, 22, 3, True)
    ]


def test_the_text_of_an_earlier_arrival_is_compared(spark, tmp_path):
    """Texts with one digest, one of which came before."""
    state, same = str(tmp_path / "state"), lambda text: F.lit("same")
    schema = "doc_id long, text string"
    exact_dedup.assign(spark.createDataFrame([(1, "x")], schema), digest=same, state_folder=state).count()
    found = exact_dedup.assign(spark.createDataFrame([(2, "y"), (3, "x"), (4, "y")], schema), digest=same, state_folder=state).collect()
    assert sorted((r["id"], r["keep"], r["kept"]) for r in found) == [(2, 2, True), (3, 1, False), (4, 2, False)]


def test_exact_dedup_of_rows_without_ids_and_repeated_rows(spark):
    rows = [(None, "a"), (None, "a"), (7, "a"), (7, "a"), (8, None), (9, "")]
    found = exact_dedup.assign(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["id"] or 0, r["keep"], r["group_size"], r["kept"]) for r in found)) == [
        (0, 7, 4, False), (0, 7, 4, False), (7, 7, 4, False), (7, 7, 4, True), (8, 8, 2, True), (9, 8, 2, False)
    ]


# Token counts


def test_token_count_query_against_plain_dynamic_programming(spark, sf):
    import base64
    import math

    import regex

    cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    with open(queries.tokenizer("byte_bpe_50k.tiktoken"), "rb") as file:
        scores = {base64.b64decode(a): -math.log(int(b) + 2) for a, b in map(bytes.split, file)}
    unknown, known = min(scores.values()), {}
    found = by_id(queries.op7_token_counts(spark, sf))
    texts = documents(spark, sf)
    assert set(found) == set(texts)
    for i, text in texts.items():
        words = cut.findall(text)
        for word in set(words).difference(known):
            known[word] = best_cut(word.encode(), scores, unknown)
        assert found[i]["n_pretokens"] == len(words)
        assert found[i]["n_tokens"] == sum(known[w][0] for w in words)
        assert found[i]["score"] == pytest.approx(sum(known[w][1] for w in words))


def test_one_word_of_many_letters(spark):
    """Long words without a space: counted, encoded and searched whole."""
    word = "abcdefghij" * 3000
    frame = spark.createDataFrame([(1, word), (2, word + "."), (3, None)], "doc_id long, text string")
    counts = by_id(token_counts.count_tokens(frame, queries.tokenizer("byte_bpe_50k.tiktoken")))
    assert counts[1]["n_pretokens"] == 1 and counts[2]["n_pretokens"] == 2
    assert counts[2]["n_tokens"] == counts[1]["n_tokens"] + 1 and counts[3]["n_tokens"] == 0
    model = queries.tokenizer("piece_bpe_32k.model")
    encoded = by_id(sentencepieces.encode(frame, model, ids=True))
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    assert encoded[1]["ids"] == library.encode(word, add_eos=True)

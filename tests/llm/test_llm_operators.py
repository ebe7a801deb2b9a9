"""The operators for training data against plain Python, on small tables and odd rows."""

import hashlib
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from citewise.llm import exact_dedup, language, near_dedup, packing, pii, queries, sentencepieces, token_counts, topk, toxicity, url_filter

DOCS = "doc_id long, text string"
ODD = [None, "", " ", "a", "Ünïcödé 語 text \t\n end", "mail a.b@c-d.org now", "word " * 30_000, "word " * 30_000]


@pytest.fixture
def odd(spark):
    """Odd texts, with columns whose names operators use themselves."""
    rows = [(i, t, i, "x", 0.5) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, DOCS + ", id long, node string, score double").cache()


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(frame, name="doc_id"):
    rows = frame.collect()
    found = {r[name]: r for r in rows}
    assert len(found) == len(rows)
    return found


def documents(spark, sf):
    return {r[0]: r[1] or "" for r in queries.table(spark, sf, "documents").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", queries.SQL)
def test_query_equals_its_sql(spark, sf, name):
    duck = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    expected = duck.execute(queries.SQL[name])
    columns = [c[0] for c in expected.description]
    found = queries.QUERIES[name](spark, sf)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(expected.fetchall(), key=repr)


# Exact dedup


def test_exact_dedup_of_odd_rows(odd, empty):
    found = by_id(exact_dedup.assign(odd), "id")
    assert [found[i]["keep"] for i in range(len(ODD))] == [0, 0, 2, 3, 4, 5, 6, 6]
    assert exact_dedup.assign(empty).count() == 0


def test_exact_dedup_tells_colliding_digests_apart(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "c d"), (6, "c \t d")], DOCS)
    found = by_id(exact_dedup.assign(rows, digest=lambda t: F.lit("same")), "id")
    assert {i: r["keep"] for i, r in found.items()} == {1: 1, 2: 2, 3: 1, 4: 2, 5: 5, 6: 5}
    assert {r["group_size"] for r in found.values()} == {2}


# Top k


def test_top_k_against_all_scores(spark):
    rng = np.random.default_rng(3)
    vectors = {i: rng.integers(-3, 4, 6).tolist() for i in range(300)}
    rows = [(i, [float(x) / 64 for x in v]) for i, v in vectors.items()]
    rows += [(300, None), (301, []), (302, [1.0, float("nan")]), (303, [None, 1.0]), (304, [float("inf")])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in topk.top_k(topk.whole_vectors(frame, "vec_id", "embedding"), F.col("id") % 20 == 0, 7).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    for q in range(0, 300, 20):
        scores = sorted((-int(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:7]
        assert found[q] == [(i, -s) for s, i in scores]
    assert set(found) == set(range(0, 300, 20))


def test_top_k_with_few_candidates_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    whole = topk.whole_vectors(frame, "vec_id", "embedding")
    assert [tuple(r) for r in topk.top_k(whole, F.col("id") == 0, 5).collect()] == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(whole.where("false"), F.col("id") == 0, 5).count() == 0


# Personal data

PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub("[^0-9]", "", s)) <= 19 and luhn(re.sub("[^0-9]", "", s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15),
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def plain_spans(text):
    return {k: [m.span() for m in re.finditer(p, text) if ok(m.group())] for k, (p, ok) in PATTERNS.items()}


PII_TEXTS = [
    "a@b.c, x@y@z.org a..b@-.- user%1@host no@host.",
    "1.2.3.4 1.2.3.4.5 256.1.1.1 1.2.3 01.002.3.255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 22",
    "+1 (212) 555-0123 +1234567 +12 34 56 78 90 12 34 56 7 ++49.30.1234567",
    "語 a@b.cc 語 +44 20 7946 0958",
]


def test_base_spans_against_regular_expressions():
    for text in PII_TEXTS + [t or "" for t in ODD]:
        assert {k: list(map(tuple, v)) for k, v in pii.base_spans(text).items()} == plain_spans(text)


def test_pii_query_against_regular_expressions(spark, sf):
    found = by_id(queries.op3_pii(spark, sf))
    texts = documents(spark, sf)
    assert set(found) == set(texts)
    for i, text in texts.items():
        base = plain_spans(text)
        written = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in base[k])
        assert [found[i][f"n_{k}"] for k in PATTERNS] == [len(base[k]) for k in PATTERNS]
        assert found[i]["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert set(filter(None, written.split(","))) <= set(found[i]["spans"].split(","))


def test_redaction_hides_spans_and_keeps_the_rest(odd, empty):
    field = pii.train(pii.labelled_examples())
    found = by_id(pii.redact(odd, field))
    assert found[0]["text"] is None and found[5]["text"] == "mail <EMAIL> now"
    assert all(found[i]["text"] == ODD[i] for i in (1, 2, 3, 4, 6, 7))
    assert found[4]["node"] == "x" and pii.redact(empty, field).count() == 0


def test_viterbi_against_all_paths():
    from itertools import product

    rng = np.random.default_rng(1)
    emit, move = rng.normal(size=(6, 3)), rng.normal(size=(3, 3))
    best = max(product(range(3), repeat=6), key=lambda p: sum(emit[i, s] for i, s in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:])))
    assert tuple(pii.viterbi(emit, np.array([6]), move)) == best


# Language


def test_language_on_held_out_documents(spark, sf):
    lang = {r[0]: r[1] for r in queries.table(spark, sf, "documents").select("doc_id", "lang").collect()}
    found = by_id(queries.op4_language(spark, sf))
    assert set(found) == set(lang)
    held = [i for i, r in found.items() if r["held_out"] and lang[i] and r["lang_pred"] != "und"]
    assert sum(found[i]["lang_pred"] == lang[i] for i in held) >= 0.9 * len(held) > 0
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_of_odd_rows(spark, odd, empty):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr")] * 4)]
    model = language.fit(spark.createDataFrame(rows, DOCS + ", lang string"))
    found = by_id(language.identify(odd, model, ["doc_id"]))
    assert [found[i]["lang_pred"] for i in range(3)] == ["und"] * 3
    assert all(found[i]["lang_pred"] in ("en", "de", "fr") for i in range(3, len(ODD)))
    assert language.identify(empty, model, ["doc_id"]).count() == 0
    untrained = language.fit(spark.createDataFrame([], DOCS + ", lang string"))
    assert {r["lang_pred"] for r in language.identify(odd, untrained, ["doc_id"]).collect()} == {"und"}


# URL filter


def test_url_filter_takes_the_longest_entry_and_follows_subdomains(spark):
    urls = [None, "", "nothing", "http://A.Example.org/es/x?q", "https://example.org/en/12#f", "x://notexample.org/es/", "http://b.com/de", "http://b.com/fr/", "http://b.com/fr/"]
    host, path = url_filter.url_parts(F.col("url"))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").select("page_id", host.alias("host"), path.alias("path"))
    rules = spark.createDataFrame(queries.RULES, "host string, path string, verdict string")
    found = by_id(url_filter.match(pages, rules, ["page_id"], "host", "path"), "page_id")
    assert [found[i]["entry"] for i in range(len(urls))] == [None, None, None, "example.org/es/", "example.org/en/1", "org/", None, "com/fr/", "com/fr/"]
    assert url_filter.match(pages, rules.where("false"), ["page_id"], "host", "path").where("entry is not null").count() == 0
    assert url_filter.match(pages.where("false"), rules, ["page_id"], "host", "path").count() == 0


def test_url_look_up_confirms_the_string_behind_a_digest(monkeypatch):
    monkeypatch.setattr(url_filter, "digests", lambda strings: np.full(len(strings), 9, np.uint64))
    raw = [b"one", b"two"]
    ends = np.cumsum([len(r) for r in raw])
    found = url_filter.look_up(np.full(2, 9, np.uint64), ends, b"".join(raw), ["two", "three", "one"])
    assert found.tolist() == [1, -1, 0]


# SentencePiece


def test_sentencepiece_against_the_library(spark, odd, empty):
    import sentencepiece

    path = queries.tokenizer("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    # Without the check the operator stands alone.
    found = by_id(sentencepieces.encode(odd, path, ids=True, check=False))
    for i, text in enumerate(ODD):
        ids = library.encode(text or "", add_bos=False, add_eos=True)
        assert found[i]["ids"] == ids and found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    back = by_id(sentencepieces.decode(sentencepieces.encode(odd, path, ids=True), path))
    assert all(back[i]["text"] == library.decode(found[i]["ids"]) for i in back)
    assert sentencepieces.encode(empty, path).count() == 0


# Token counts


def best_cut(word, scores, unknown):
    """Highest score, then fewest tokens, by plain dynamic programming."""
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        options = [(best[a][0] + scores[word[a:end]], best[a][1] - 1) for a in range(end) if word[a:end] in scores]
        options.append((best[end - 1][0] + scores.get(word[end - 1 : end], unknown), best[end - 1][1] - 1))
        best[end] = max(options)
    return -best[-1][1], best[-1][0]


def test_trie_against_plain_dynamic_programming():
    rng = np.random.default_rng(2)
    scores = {bytes(rng.choice(list(b"abc"), rng.integers(1, 4)).tolist()): -float(rng.integers(1, 9)) for _ in range(25)}
    trie = token_counts.Trie(scores)
    for _ in range(200):
        word = bytes(rng.choice(list(b"abcd"), rng.integers(1, 9)).tolist())
        count, score = trie.insert(word)
        expected = best_cut(word, scores, trie.unknown)
        assert count == expected[0] and score == pytest.approx(expected[1])


def test_token_counts_of_odd_rows(odd, empty):
    path = queries.tokenizer("byte_bpe_50k.tiktoken")
    found = by_id(token_counts.count_tokens(odd, path))
    assert [found[i]["n_tokens"] for i in (0, 1, 3)] == [0, 0, 1]
    assert found[6]["n_tokens"] == found[7]["n_tokens"] >= 30_000
    assert token_counts.count_tokens(empty, path).count() == 0


# Toxicity


def test_toxicity_on_held_out_documents(spark, sf):
    toxic = {r[0]: r[1] for r in queries.table(spark, sf.replace("0.001", "0.01"), "labels").select("doc_id", "toxic").collect()}
    found = by_id(queries.op8_toxicity(spark, sf.replace("0.001", "0.01")))
    held = [i for i, r in found.items() if r["held_out"] and toxic.get(i) is not None]
    assert sum(found[i]["predicted"] == toxic[i] for i in held) >= 0.9 * len(held) > 0
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())


def test_toxicity_without_labels_and_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    for known in (labels, labels.where("false")):
        model = toxicity.fit(odd, known)
        assert all(0 <= r["score"] <= 1 for r in toxicity.score(odd, model, ["doc_id"]).collect())
        assert toxicity.score(empty, model, ["doc_id"]).count() == 0


# Packing


def check_packing(frame, texts, window=1024):
    import zlib

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    pieces, places = defaultdict(list), defaultdict(list)
    for r in frame.collect():
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["length"] > 0
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    padding = 0
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_packing_of_the_table(spark, sf):
    sf = sf.replace("0.001", "0.01")
    texts = documents(spark, sf)
    frame = queries.op9_packing(spark, sf).cache()
    total = frame.agg(F.sum("length")).first()[0]
    assert check_packing(frame, texts) <= max(1024, 0.02 * total)


def test_packing_of_odd_rows(odd, empty):
    check_packing(packing.pack(odd, queries.tokenizer("byte_bpe_50k.json")), dict(enumerate(ODD)))
    assert packing.pack(empty, queries.tokenizer("byte_bpe_50k.json")).count() == 0


# Near dedup


def words_of(text):
    words = (re.sub(r"^\W+|\W+$", "", w.replace("_", " ")) for w in (text or "").lower().split())
    return [w for w in words if w]


def runs_of(text):
    words = words_of(text)
    width = min(5, len(words))
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if width else Counter()


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def plain_classes(texts):
    runs = {i: runs_of(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            if runs[i] == runs[j] and words_of(texts[i]) == words_of(texts[j]) or jaccard(runs[i], runs[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def family(rng, size, words=120, changes=3):
    base = [f"w{x}" for x in rng.integers(0, 10_000, words)]
    for _ in range(size):
        copy = list(base)
        for at in rng.integers(0, words, changes):
            copy[at] = f"v{rng.integers(0, 10**6)}"
        yield " ".join(copy)


def test_near_dedup_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    texts = [t for size in (60, 2, 3, 1, 1, 5) for t in family(rng, size)]
    texts += [None, "", "one two", "One, two!", "one three", texts[0], texts[0].upper()]
    frame = spark.createDataFrame(list(enumerate(texts)), DOCS)
    found = by_id(near_dedup.classes(frame), "id")
    expected = plain_classes(dict(enumerate(texts)))
    assert {i: r["class_id"] for i, r in found.items()} == expected
    sizes = Counter(expected.values())
    assert all(r["class_size"] == sizes[r["class_id"]] for r in found.values())


def test_near_dedup_of_odd_rows(spark, odd, empty):
    found = by_id(near_dedup.classes(odd), "id")
    assert [found[i]["class_id"] for i in range(len(ODD))] == [0, 0, 0, 3, 4, 5, 6, 6]
    assert near_dedup.classes(empty).count() == 0
    assert sorted(r[0] for r in near_dedup.keep_one(odd).select("doc_id").collect()) == [0, 3, 4, 5, 6]
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "a b"), (3, "c d")], DOCS)
    assert {r["id"]: (r["class_id"], r["class_size"]) for r in near_dedup.classes(twice).collect()} == {1: (1, 2), 2: (1, 2), 3: (3, 1)}


def test_weighted_signatures_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(4)
    shared, one, two = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (150, 25, 25))
    a, b = (near_dedup.elements(np.concatenate([shared, shared[:50], x])) for x in (one, two))
    found = near_dedup.signatures([a, b], 4000)
    assert abs((found[0] == found[1]).mean() - 200 / 250) < 0.03
    assert near_dedup.similarity(np.sort(a), np.sort(b)) == 200 / 250

"""Main text, Merkle manifest and word runs against plain Python, on small tables and odd rows."""

import hashlib
import html
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from citewise.llm import main_text, merkle, queries, word_runs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Main text


def article_of(page):
    """The given pages hold one flat article each: its headline and paragraphs."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>", "", inside.replace("<br>", " ")))
    blocks = [" ".join(html.unescape(b).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_main_text_of_the_given_pages(spark, sf):
    pages = {r["page_id"]: r for r in queries.table(spark, sf, "pages").collect()}
    found = queries.op11_main_text(spark, sf).collect()
    assert sorted(r["page_id"] for r in found) == sorted(pages)
    for r in found:
        assert r["text"] == article_of(pages[r["page_id"]]["html"]) and r["url"] == pages[r["page_id"]]["url"]
        assert r["n_chars"] == len(r["text"])


FURNITURE = [
    "<nav><ul><li><a href=/a>Home, sweet home</a><li><a href=/b>News</a></ul></nav>",
    "<header><h1>The site, its name; and its claim.</h1></header>",
    '<div class="cookie-notice"><p>We, and 900 partners, use cookies; do you agree? Yes, no, or maybe.</p></div>',
    '<div id="leftSidebar"><p>Also here, on the left, there is much to read, and more of it.</p></div>',
    "<aside><p>By the way, there is this, and that, and all of it is beside the point.</p></aside>",
    "<div class='ad'>Buy now, pay later, think never. It is cheap, and good.</div>",
    "<form><label>Mail, please</label><input name=m><select><option>one, two</select><textarea><p>no</textarea></form>",
    "<script>var t = '</p><p>not, text; at all.</p>';</script><style>p { margin: 0 }</style><noscript>Turn, it, on.</noscript>",
    '<section id="reader-comments"><article class="comment"><p>I, for one, liked it, very much, indeed.</p></article></section>',
    "<!-- <p>no, not this one.</p> --><template><p>nor, this</p></template><p hidden>nor, that.</p>",
    "<footer>&copy; 2020, all rights reserved, by us.</footer>",
]


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main><article>%s</article></main>", "<div role=main>%s</div>"])
def test_main_text_is_the_article_without_furniture(wrap):
    rng = random.Random(5)
    for _ in range(50):
        blocks = [" ".join(rng.choices(["word", "a<b", "x&y", "Ünï", "語。", "end."], k=rng.randint(1, 30))) for _ in range(8)]
        body = f"<h1>{html.escape(blocks[0])}</h1><p>"
        body += "<p>".join(f"  <b>{html.escape(b)}</b>\n " for b in blocks[1:5])
        body += f"<ul><li>{html.escape(blocks[5])}<li>{html.escape(blocks[6])}</ul><table><tr><td>{html.escape(blocks[7])}</table>"
        mixed = rng.sample(FURNITURE, len(FURNITURE))
        page = "<!DOCTYPE html><html><head><title>No, title.</title></head><body>"
        page += "".join(mixed[:5]) + wrap % body + "".join(mixed[5:])
        assert main_text.main_text(page + rng.choice(["", "</body></html>"])) == "\n".join(blocks)


@pytest.mark.parametrize("furniture", [f for f in FURNITURE if not f.startswith("<header")])
def test_furniture_inside_the_article_goes_too(furniture):
    long = "A long paragraph, with commas; and with quite some words, to be the content here."
    page = f"<body><article><header><h1>Head</h1></header><p>{long}</p>{furniture}<p>{long}</p></article>"
    assert main_text.main_text(page) == f"Head\n{long}\n{long}"


def test_paths_choose_where_nothing_is_declared():
    long = "A long paragraph, with commas; and with quite some words, to be the content here. "
    menu = "<div><ul>" + "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(12)) + "</ul></div>"
    text = f"<h1>Head</h1><p>{long}</p><h2>Sub</h2><p>Short.</p><p>{long * 3}</p><p>{long * 2}</p>"
    end = "<div><p>Copyright 2020</p></div>"
    expected = "\n".join(["Head", long.strip(), "Sub", "Short.", (long * 3).strip(), (long * 2).strip()])
    for page in (f"<body>{menu}<div>{text}</div>{end}", f"<table><tr><td>{menu}<td><div>{text}</div></table>{end}"):
        assert main_text.main_text(page) == expected


def test_names_that_mark_furniture():
    marks = ("site-menu", "topNav", "commentlist", "cookiebar", "left sidebar-2", "ad", "adsbygoogle", "pageFooter", "js-newsletter-form", "header")
    plain = ("content", "with-sidebar", "no-comments", "commentary", "download", "headline", "badge", "thread", "post", "adult", "")
    assert all(main_text.marked_as_furniture(m) for m in marks)
    assert not any(main_text.marked_as_furniture(p) for p in plain)
    assert not main_text.marked_as_furniture("entry-header", in_article=True)


def test_pages_of_tables_and_plain_boxes():
    long = "A long paragraph, with commas; and with quite some words, to be the content here."
    menu = "<td><a href=1>A</a><br><a href=2>B</a><br></td>"
    assert main_text.main_text(f"<table><tr>{menu}<td><b>Head</b><br>{long}<br>{long}</td></table>") == f"Head {long} {long}"
    boxes = f"<div id=top><a>x</a></div><div class=col><h1>T</h1><div>{long}</div><div>{long}{long}</div><div>End.</div></div>"
    page = f"<body><div class=cookiebar>{long}</div><div id=wrap>{boxes}<div id=commentlist><div>{long}</div></div></div>"
    assert main_text.main_text(page) == f"T\n{long}\n{long}{long}\nEnd."


def test_scores_follow_length_and_punctuation():
    score, least = main_text.path_scores(np.array([1, 2, 2, 2, 1]), np.array([5.0, 200, 180, 220, 6]), np.array([0.0, 6, 5, 7, 0]))
    assert score[1] == score[2] == score[3] > least > score[0] == score[4]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("just text &amp; more <b>bo</b>ld", "just text & more bold"),
        ("<p>a&nbsp;&#32;\n\tb<br>c&lt;p&gt;&#x8a9e;</p>", "a b c<p>語"),
        ("<p>one<p>two<!-- open", "one\ntwo"),
        ("a < b <3 &notit; <a href='x", "a < b <3 ¬it;"),
        ("<article><p>x<b>y</p>z</b></article></article></p>", "xy\nz"),
        ("<p title='a hidden > gem' data-x=\"class\">seen</p>", "seen"),
        ("<script>no", ""),
    ],
)
def test_main_text_of_odd_pages(page, text):
    assert main_text.main_text(page) == text


def test_main_text_of_long_and_deep_pages():
    assert main_text.main_text("<div>" * 100_000 + "deep, text." + "</div>" * 9) == "deep, text."
    assert main_text.main_text("<p><b>" * 50_000 + "x") == "x"
    assert main_text.main_text("<article><p>" + "word, " * 200_000) == ("word, " * 200_000).strip()
    assert main_text.main_text('<a b="' * 50_000 + "<!--" * 50_000) == ""


def test_main_text_of_odd_tables(spark):
    rows = [(1, None, "a"), (1, "<p>x", "b"), (None, "", None), (1, "<p>x", "b")]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = main_text.extract(frame, ["page_id"]).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, ""), (1, "x"), (None, ""), (1, "x")], key=repr)
    assert main_text.extract(frame.where("false"), ["page_id"]).count() == 0


# Merkle manifest


def plain_tree(leaves):
    """(root, one list of (before, after) digests for each leaf)."""
    level, paths, place = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, at in enumerate(place):
            run = at // 3 * 3
            paths[i].append((level[run:at], level[at + 1 : run + 3]))
        place = [at // 3 for at in place]
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def plain_fold(digest, path):
    for before, after in path:
        digest = sha("".join([*before, digest, *after]))
    return digest


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_manifest(rows):
    """The query's result for (doc_id, source, lang, n_chars, text) rows."""
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0], plain_leaf(*row), row))
    trees = {s: sorted(t, key=lambda x: (x[0], x[1] or 0, x[2])) for s, t in trees.items()}
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    inner = {s: plain_tree([x[2] for x in trees[s]]) for s in order}
    root, outer = plain_tree([inner[s][0] for s in order]) if order else (None, [])
    out = []
    for s, above in zip(order, outer):
        subroot, paths = inner[s]
        for (_, doc_id, leaf, row), path in zip(trees[s], paths):
            proof = sha("".join("".join(b + a) for b, a in path + above))
            changed = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and row[4] is not None:
                changed = plain_leaf(*row[:4], row[4].replace("\n", ""))
            fold = plain_fold(changed, path + above)
            out.append((doc_id, leaf, subroot, root, proof, fold, fold == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80, 82])
def test_appended_witnesses_fold_to_the_root(size):
    leaves = [sha(str(i)) for i in range(size)]
    if not size:
        return
    append = merkle.Append()
    for leaf in leaves:
        append.add(leaf)
    root, paths = plain_tree(leaves)
    assert append.root(merkle.height(size)) == root
    steps = [[f"{len(b)}" + "".join(b + a) for b, a in path] for path in paths]
    assert append.witnesses == steps


@pytest.mark.parametrize("block_height", [1, 2, 7])
def test_manifest_of_many_blocks_and_odd_rows(spark, monkeypatch, tmp_path, block_height):
    monkeypatch.setattr(merkle, "HEIGHT", block_height)
    monkeypatch.setattr(merkle, "BLOCK", 3**block_height)
    rng = random.Random(block_height)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", None if i % 5 else "en", i % 11, f"text\n{i}") for i in rng.sample(range(-50, 400), 230)]
    rows += [(1, "one", "en", 1, "alone"), (None, None, None, None, None), (7, None, "", 0, ""), (7, None, "", 0, "")]
    rows += [(None, "hot", "x", 1, "a\nb"), (5, "hot", "x", 1, "a"), (5, "hot", "y", 1, "b"), (9, "Ünï", "語", 1, "long\n" * 50_000)]
    rows += [(3, "", None, None, "empty source"), (4, "s", None, None, "")]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, at int, steps int")
    docs.repartition(7).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op12_merkle_manifest(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=repr) == plain_manifest(rows)


def test_manifest_of_no_rows(spark, tmp_path):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op12_merkle_manifest(spark, str(tmp_path)).count() == 0


def test_manifest_of_the_given_documents(spark, sf):
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in queries.table(spark, sf, "documents").collect()]
    found = queries.op12_merkle_manifest(spark, sf).collect()
    assert sorted(map(tuple, found), key=repr) == plain_manifest(rows)
    assert {r["verified"] for r in found} == {True, False}


# Word runs


def plain_runs(words, exponent, least):
    """All runs: every period tried at every place, smallest period only."""
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - i
            stretch = words[i : i + length]
            smaller = any(all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q))
            if length >= max(least, exponent * q) and not smaller:
                found.append((i, length, q))
            i = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_lyndon(ranks):
    def longest(i):
        return max(k for k in range(1, len(ranks) - i + 1) if all(ranks[i : i + k] < ranks[i + j : i + k] for j in range(1, k)))

    return [longest(i) for i in range(len(ranks))]


def test_lyndon_groups_against_every_word():
    rng = random.Random(2)
    cases = [list(c) for n in range(1, 7) for c in product(range(3), repeat=n)]
    cases += [[rng.randrange(k) for _ in range(40)] for k in (1, 2, 3, 9) for _ in range(40)]
    for ranks in cases:
        groups, sizes = word_runs.lyndon_groups(ranks)
        assert sizes.tolist() == plain_lyndon(ranks)
        words = [tuple(ranks[i : i + k]) for i, k in enumerate(sizes.tolist())]
        for i, j in ((rng.randrange(len(ranks)), rng.randrange(len(ranks))) for _ in range(20)):
            assert (groups[i] == groups[j]) == (words[i] == words[j])


@pytest.mark.parametrize(("exponent", "least"), [(2, 2), (3, 1), (4, 6)])
def test_runs_against_every_period(exponent, least):
    rng = random.Random(exponent)
    cases = [list(c) for n in range(9) for c in product(range(2), repeat=n)]
    for _ in range(300):
        words = [rng.randrange(3) for _ in range(rng.randrange(30))]
        for _ in range(2):
            root = [rng.randrange(3) for _ in range(rng.randint(1, 5))]
            words += (root * 6)[: rng.randint(1, 30)] + [rng.randrange(4) for _ in range(rng.randrange(4))]
        cases.append(words)
    for words in cases:
        assert word_runs.runs_of(np.array(words, np.int64), exponent, least) == plain_runs(words, exponent, least)
    texts = [" ".join(map(str, w)) for w in cases]
    _, runs, _ = word_runs.runs_in_texts(texts, [None] * len(texts), exponent, least)
    assert runs == [plain_runs(w, exponent, least) for w in cases]


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, 4, 6)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines), sha(kept))


def test_word_runs_of_the_given_documents(spark, sf):
    rows = queries.table(spark, sf, "documents").select("doc_id", "text").where("doc_id < 60").collect()
    found = {r["doc_id"]: tuple(r) for r in queries.op13_word_runs(spark, sf).collect()}
    assert len(found) == queries.table(spark, sf, "documents").count()
    for doc_id, text in rows:
        assert found[doc_id] == plain_row(doc_id, text)
    assert any(r[1] for r in found.values())


def test_word_runs_of_odd_rows(spark, tmp_path):
    looped = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rng = random.Random(4)
    texts = [None, "", " \t\n", "a", "a " * 6, "a a a a a b " * 3, "x y x y x y x y", "a b " * 3 + "a c " * 5]
    texts += [" ".join(rng.choices("ab", k=60)) for _ in range(20)] + ["w%d " % i for i in range(3)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(i, " ".join(f"w{k}" for k in range(rng.randrange(90)))) for i in looped]
    rows += [(None, "n n n n n n n"), (3, "a"), (4, "a " * 6)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, runs int, collapsed string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_word_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted((plain_row(*r) for r in rows), key=repr)
    frame.where("false").write.parquet(str(tmp_path / "empty" / "documents.parquet"))
    assert queries.op13_word_runs(spark, str(tmp_path / "empty")).count() == 0


def test_word_runs_of_long_texts():
    one = "x" * 1_000_000
    texts = ["a b c " * 100_000, one, " ".join([one[:1000]] * 500), " ".join(str(i) for i in range(100_000))]
    sizes, runs, collapsed = word_runs.runs_in_texts(texts, [None] * 4, 4, 6)
    assert sizes == [300_000, 1, 500, 100_000]
    assert runs == [[(0, 300_000, 3)], [], [(0, 500, 1)], []]
    assert collapsed == ["a b c", one, one[:1000], texts[3]]


def test_strongest_run_compares_exactly(spark):
    big = 10**9
    runs = [(0, 9, 2), (5, 4 * big + 1, big), (7, 45, 10), (7, 9, 2)]
    frame = spark.createDataFrame([([dict(zip(("start", "length", "period"), r)) for r in rs],) for rs in (runs, runs[1:2], [])], f"runs {word_runs.RUNS}")
    found = frame.select(word_runs.strongest(F.col("runs")).alias("best")).collect()
    assert [r["best"] and tuple(r["best"]) for r in found] == [(0, 9, 2), runs[1], None]

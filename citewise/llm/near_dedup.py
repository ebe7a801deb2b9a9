"""Near-duplicate classes by DartMinHash signatures and a banded join.

A document is the multiset of its runs of five words. Each element of weight w owns a
region of width w; hashed darts fall on it, about one for each unit of area (weight x
rank). A dart is the same for every document whose region it hits. It carries a
coordinate; the dart of lowest rank in a coordinate is the signature there, so that two
documents agree in a coordinate with a probability equal to their weighted Jaccard
similarity. Ranks are searched upwards only until every coordinate has a dart, so a
document costs about (elements + k log k) darts, not elements x k.

Signatures are cut into bands; documents that agree in a band share a bucket. Documents
with the same words are one node from the start. In each bucket all nodes are compared
with one hub, on their whole texts; linked components join (label propagation over written
tables). Buckets whose nodes are all in one component are finished. When another hub joins
little more, the other buckets are cut into blocks of bounded size, and every two blocks
meet in a task of their own: there all their texts are compared at once (the overlaps of
all pairs are one product of two matrices), and only links that join components are given
out, fewer than a block has nodes. So no class is cut in two, pairs never become rows,
and a bucket of any size is many tasks.

A member is compared with a hub only if their sizes allow the similarity, and if the lowest
bits of their signatures differ in few enough places: a pair at the threshold fails that
with a chance of 2 in 100,000, and then still meets in the blocks. It shares no band with a
chance of 2 in 10,000.

Words are lower-cased, without punctuation at their ends; a text of fewer than five words
is one run. Defined results: one row for each distinct id. NULL and empty texts have no
words and are copies of each other. Of different texts under one id the one with the
smallest digest counts; rows without an id count as one id, and a class whose only id is
NULL has NULL for its class. Texts of any length are compared whole. An empty table gives no
rows. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TokenTable, map_texts, mix, small_batches, stored

WORDS, THRESHOLD, BANDS, ROWS = 5, 0.8, 28, 6
#: Signature bits that may differ: (1 - threshold) / 2 of them are expected to, and this
#: many standard deviations more are allowed.
DEVIATIONS = 4.5
#: What one side of a task of two blocks holds: word runs, a member counting as so many at
#: least (so 512 members at most, on average).
BLOCK_RUNS, LEAST_RUNS = 1 << 18, 512
#: Columns of the matrices that are multiplied at a time.
COLUMNS = 4096
#: A further hub is tried while the last one left less than this share of the open pairs.
#: Compared texts are held in a task up to so many word runs.
HUB_SHARE, HELD_RUNS = 0.8, 4_000_000
#: A list of up to so many ids (24 bytes each) may be broadcast.
BROADCAST_IDS = 500_000
_K = np.uint64(0x9E3779B97F4A7C15)
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])


def word_table() -> TokenTable:
    def edges(token: str) -> str:
        low, high = 0, len(token)
        while low < high and not token[low].isalnum():
            low += 1
        while high > low and not token[high - 1].isalnum():
            high -= 1
        return token[low:high]

    def compute(tokens):
        words = [edges(t) for t in tokens]
        return np.array([xxhash.xxh3_64_intdigest(w) if w else 0 for w in words], np.uint64), np.array([bool(w) for w in words])

    return TokenTable(compute)


def shingles(texts: list[str | None], table: TokenTable, size: int = WORDS) -> tuple[list[np.ndarray], list[bytes]]:
    """The hashed word runs of each text, repeats included, and a digest of its words."""
    cut = [(t or "").lower().split() for t in texts]
    rows = table.rows([w for c in cut for w in c])
    runs, keys, at = [], [], 0
    for c in cut:
        mine = rows[at : at + len(c)]
        at += len(c)
        words = table.values[0][mine][table.values[1][mine]] if len(mine) else np.zeros(0, np.uint64)
        keys.append(hashlib.md5(words.tobytes()).digest())
        width = min(size, len(words))
        out = np.full(max(0, len(words) - width + 1) if width else 0, width, np.uint64)
        for i in range(width):
            out = mix(out * _K + words[i : i + len(out)])
        runs.append(out)
    return runs, keys


def elements(runs: np.ndarray) -> np.ndarray:
    """One element for each unit of weight: the i-th repeat of a run is an element."""
    ordered = np.sort(runs)
    if not len(ordered):
        return ordered
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    repeat = np.arange(len(ordered)) - np.repeat(first, np.diff(np.append(first, len(ordered))))
    return mix(ordered + repeat.astype(np.uint64) * _K)


def signatures(documents: list[np.ndarray], k: int = BANDS * ROWS) -> np.ndarray:
    """Lowest dart of each coordinate for each document (an array of its elements)."""
    out = np.full(len(documents) * k, np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(d) for d in documents], np.int64)
    enough = np.ceil((k * math.log(k) + 2 * k) / np.maximum(sizes, 1)).astype(np.int64)
    live = sizes > 0
    flat = np.concatenate([*documents, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(documents)), sizes)
    for rank in count():
        if rank and (stop := live & (enough <= rank)).any():
            full = (out.reshape(len(documents), k) != np.iinfo(np.uint64).max).all(1)
            live &= ~(stop & full)
        mine = live[owner]
        if not mine.all():
            flat, owner = flat[mine], owner[mine]
        if not len(flat):
            return out.reshape(len(documents), k)
        seed = mix(flat + np.array([rank + 1], np.uint64) * np.uint64(0xD1B54A32D192ED03))
        n = np.searchsorted(_POISSON, (seed >> np.uint64(11)) / 2.0**53, "right")
        start = np.cumsum(n) - n
        nth = (np.arange(n.sum()) - np.repeat(start, n)).astype(np.uint64)
        dart = mix(np.repeat(seed, n) + (nth + np.uint64(1)) * _K)
        key = (np.uint64(rank) << np.uint64(48)) | (mix(dart ^ _K) >> np.uint64(16))
        np.minimum.at(out, np.repeat(owner, n) * k + (dart % np.uint64(k)).astype(np.int64), key)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cells = signature.reshape(-1, bands, rows)
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(cells), 1))
    for i in range(rows):
        out = mix(out * _K + cells[:, :, i])
    return out.view(np.int64)


def low_bits(signature: np.ndarray) -> np.ndarray:
    """The lowest bit of every coordinate, 56 to a number."""
    bits = (signature & np.uint64(1)).astype(np.int64)
    whole = -(-bits.shape[1] // 56) * 56
    bits = np.pad(bits, ((0, 0), (0, whole - bits.shape[1]))).reshape(len(bits), -1, 56)
    return (bits << np.arange(56)).sum(2)


def signed(docs: DataFrame, id_col: str, text_col: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, node (digest of the words), band keys (none without words), number of word runs
    and lowest bits of the signature."""

    def make():
        table = word_table()

        def work(texts):
            runs, keys = shingles(texts, table)
            signature = signatures([elements(r) for r in runs], bands * rows)
            found = band_keys(signature, bands, rows)
            return {
                "node": keys,
                "bands": [list(b) if len(r) else [] for b, r in zip(found, runs)],
                "size": [len(r) for r in runs],
                "bits": list(low_bits(signature)),
            }

        return work

    return map_texts(docs, [id_col], text_col, make, "node binary, bands array<long>, size int, bits array<long>").withColumnRenamed(id_col, "id")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets, given as sorted elements."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def linked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) whose whole texts are similar enough."""
    sided = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
    sided = sided.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b").select("a", "a_text", "b", "b_text")
    small_batches(pairs.sparkSession)

    def run(frames):
        table = word_table()
        held: dict[bytes, np.ndarray] = {}
        holds = 0

        def of(node, text):
            nonlocal holds
            if node not in held:
                if holds > HELD_RUNS:
                    held.clear()
                    holds = 0
                held[node] = np.sort(elements(shingles([text], table)[0][0]))
                holds += len(held[node])
            return held[node]

        for frame in frames:
            good = [similarity(of(a, s), of(b, t)) >= threshold for a, s, b, t in zip(frame["a"], frame["a_text"], frame["b"], frame["b_text"])]
            yield frame.loc[good, ["a", "b"]]

    return sided.mapInPandas(run, "a binary, b binary")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, comp): the least node of each connected component, by label propagation
    with pointer jumping; every step is a written table."""
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = nodes.select("node", F.col("node").alias("comp"))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a"), "left").select("node", F.col("comp").alias("was"), F.least("comp", F.coalesce("near", "comp")).alias("up"))
        step = stored(step, "step")
        above = step.select(F.col("node").alias("up"), F.col("up").alias("jump"))
        after = step.join(above, "up", "left").select("node", F.coalesce("jump", "up").alias("comp"), (F.coalesce("jump", "up") != F.col("was")).alias("moved"))
        after = stored(after, "labels")
        labels = after.select("node", "comp")
        if after.where("moved").isEmpty():
            return labels


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after the links: only components that a link touches are looked at."""
    one, two = (labels.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}")) for c in "ab")
    between = links.join(one, "a").join(two, "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    between = stored(between.where("a != b").distinct(), "between")
    touched = between.select(F.col("a").alias("node")).union(between.select(F.col("b").alias("node"))).distinct()
    moved = components(stored(touched, "touched"), between).select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    return stored(labels.join(moved, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")), "joined")


def _likely(one: str, two: str, threshold: float, coordinates: int) -> Column:
    """Whether the sizes and the signature bits of two members leave the pair a chance."""
    smaller, larger = F.least(f"{one}.size", f"{two}.size"), F.greatest(f"{one}.size", f"{two}.size")
    share = (1 - threshold) / 2
    most = math.floor(coordinates * share + DEVIATIONS * math.sqrt(coordinates * share * (1 - share)))
    apart = F.zip_with(f"{one}.bits", f"{two}.bits", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return (smaller >= larger * threshold) & (F.aggregate(apart, F.lit(0), lambda n, x: n + x) <= most)


def _pairs(one: str, two: str) -> list[Column]:
    return [F.least(f"{one}.node", f"{two}.node").alias("a"), F.greatest(f"{one}.node", f"{two}.node").alias("b")]


def overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many elements each of one shares with each of two."""
    out = np.zeros((len(one), len(two)), np.float32)
    mine, other = np.concatenate([*one, np.zeros(0, np.uint64)]), np.concatenate([*two, np.zeros(0, np.uint64)])
    shared = np.intersect1d(mine, other)
    if not len(shared):
        return out

    def placed(flat, sets):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
        hit = shared[at] == flat
        at, owner = at[hit], owner[hit]
        order = np.argsort(at, kind="stable")
        return at[order], owner[order]

    sides = [placed(mine, one), placed(other, two)]
    for low in range(0, len(shared), COLUMNS):
        width = min(COLUMNS, len(shared) - low)
        dense = []
        for (at, owner), sets in zip(sides, (one, two)):
            a, b = np.searchsorted(at, [low, low + width])
            cells = np.zeros((len(sets), width), np.float32)
            cells[owner[a:b], at[a:b] - low] = 1
            dense.append(cells)
        out += dense[0] @ dense[1].T
    return out


def spanning(comps: list[bytes], linked: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """Of the pairs (first[i], second[j]) with linked[i, j] those that join components."""
    number = {c: i for i, c in enumerate(sorted(set(comps)))}
    comp = np.array([number[c] for c in comps], np.int64)
    i, j = np.nonzero(linked)
    a, b = first[i], second[j]
    apart = comp[a] != comp[b]
    a, b = a[apart], b[apart]
    low, high = np.minimum(comp[a], comp[b]), np.maximum(comp[a], comp[b])
    # One pair for any two components, then only what closes no circle.
    _, at = np.unique(low * len(number) + high, return_index=True)
    root = list(range(len(number)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for k in at.tolist():
        x, y = find(int(low[k])), find(int(high[k]))
        if x != y:
            root[x] = y
            out.append((int(a[k]), int(b[k])))
    return out


def _block_links(members: DataFrame, labels: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that join all components which similar members of one bucket hold."""

    def make():
        table = word_table()
        return lambda some: {"elements": [np.sort(elements(r)).tobytes() for r in shingles(some, table)[0]]}

    wanted = texts.join(members.select("node").distinct(), "node", "left_semi")
    packed = stored(map_texts(wanted, ["node"], "text", make, "elements binary"), "elements")
    placed = members.join(labels, "node").select("bucket", "node", "comp", F.greatest("size", F.lit(LEAST_RUNS)).alias("weight"))
    per = placed.groupBy("bucket", "comp").agg(F.sum("weight").alias("held"))
    small = F.when(F.col("held") <= BLOCK_RUNS, F.col("held"))
    rest = per.groupBy("bucket").agg(F.sum(small).alias("rest"))
    # A large component has blocks of its own; small ones share blocks.
    ceiling = lambda c: F.ceil(F.col(c) / BLOCK_RUNS).cast("long")
    own = F.when(F.col("held") > BLOCK_RUNS, F.col("comp"))
    part = F.when(own.isNotNull(), F.pmod(F.xxhash64("node"), ceiling("held"))).otherwise(F.pmod(F.xxhash64("comp"), ceiling("rest")))
    placed = placed.join(per, ["bucket", "comp"]).join(rest, "bucket")
    placed = stored(placed.select("bucket", "node", "comp", F.concat_ws(":", F.hex(own), part).alias("block"), own.isNotNull().alias("one_comp")), "block-members")

    blocks = placed.groupBy("bucket", "block").agg(F.first("one_comp").alias("one_comp"), F.min("comp").alias("least"))
    left = blocks.select("bucket", F.col("block").alias("a"), F.when(F.col("one_comp"), F.col("least")).alias("a_comp"))
    right = blocks.select("bucket", F.col("block").alias("b"), F.when(F.col("one_comp"), F.col("least")).alias("b_comp"))
    meet = left.join(right, "bucket").where((F.col("a") <= F.col("b")) & ~F.coalesce(F.col("a_comp") == F.col("b_comp"), F.lit(False)))
    meet = stored(meet.select("bucket", "a", "b"), "block-pairs")
    sides = meet.select("bucket", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    together = sides.join(placed.select("bucket", "block", "node", "comp"), ["bucket", "block"]).join(packed, "node")

    def compare(group: pa.Table) -> pa.Table:
        nodes, comps = group["node"].to_pylist(), group["comp"].to_pylist()
        sets = [np.frombuffer(e, np.uint64) for e in group["elements"].to_pylist()]
        block = np.array(group["block"].to_pylist())
        first = np.flatnonzero(block == group["a"][0].as_py())
        second = np.flatnonzero(block == group["b"][0].as_py())
        sizes = np.array([len(s) for s in sets], np.float64)
        both = overlaps([sets[i] for i in first], [sets[i] for i in second]).astype(np.float64)
        union = np.maximum(1, sizes[first][:, None] + sizes[second][None, :] - both)
        links = [sorted((nodes[i], nodes[j])) for i, j in spanning(comps, both / union >= threshold, first, second)]
        return pa.table({c: pa.array([link[k] for link in links], pa.binary()) for k, c in enumerate("ab")})

    return together.groupBy("bucket", "a", "b").applyInArrow(compare, "a binary, b binary").distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, class_id (smallest id of the class), class_size, n_links (links found between
    different texts of the class) for each distinct id of docs."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    read = signed(docs, "id", "text", bands, rows)
    found = stored(read.groupBy("id").agg(F.min(F.struct("node", "bands", "size", "bits")).alias("s")).select("id", "s.*"), "signed")
    first = [F.first(c).alias(c) for c in ("bands", "size", "bits")]
    nodes = stored(found.groupBy("node").agg(F.min("id").alias("rep"), *first), "nodes")

    placed = nodes.select("node", "size", "bits", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = stored(placed.join(shared, "bucket", "left_semi"), "members")
    active = stored(members.select("node").distinct(), "active")
    wanted = stored(nodes.join(active, "node", "left_semi").select(F.col("rep").alias("id"), "node"), "wanted")
    texts = stored(_texts(docs, wanted), "texts")

    labels = active.select("node", F.col("node").alias("comp"))
    links = before = None
    for turn in count():
        placed = members.join(labels, "node")
        per = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("m"))
        live = per.groupBy("bucket").agg(F.count(F.lit(1)).alias("comps"), F.sum("m").alias("n"), F.sum(F.col("m") * F.col("m")).alias("inner")).where("comps > 1")
        live = stored(live, "live")
        total = live.agg(F.sum((F.col("n") * F.col("n") - F.col("inner")) / 2).alias("pairs"), F.sum("n").alias("n")).first()
        if not total.pairs:
            break
        last = before is not None and (total.pairs <= 4 * total.n or total.pairs > HUB_SHARE * before)
        before = total.pairs
        # Members whose buckets are finished take no more part.
        members = stored(members.join(live.select("bucket"), "bucket", "left_semi"), "members")
        if last:
            new = stored(_block_links(members, labels, texts, threshold), "links")
        else:
            placed = members.join(labels, "node").select("bucket", F.struct("node", "comp", "size", "bits").alias("one"))
            hub = placed.groupBy("bucket").agg(F.min_by("one", F.struct(F.xxhash64(F.lit(turn), "one.node"), "one.node")).alias("two"))
            pairs = placed.join(hub, "bucket").where(F.col("one.comp") != F.col("two.comp"))
            pairs = pairs.where(_likely("one", "two", threshold, bands * rows)).select(*_pairs("one", "two")).distinct()
            new = stored(linked(stored(pairs, "pairs"), texts, threshold), "links")
        if not new.isEmpty():
            links = new if links is None else links.union(new)
            labels = _joined(labels, new)
        if last:
            break
    labelled = found.select("id", "node").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    size = labelled.groupBy("comp").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    if links is None:
        count_of = labels.select("comp", F.lit(0).cast("long").alias("n")).where("false")
    else:
        count_of = links.join(labels, F.col("a") == F.col("node")).groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    size = size.join(count_of, "comp", "left")
    return labelled.join(size, "comp").select("id", "class_id", "class_size", F.coalesce("n", F.lit(0)).alias("n_links"))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the wanted (id, node); a text with another digest isn't meant."""
    few = wanted.count() <= BROADCAST_IDS
    mine = docs.join(F.broadcast(wanted) if few else wanted, "id").select("node", "text")

    def make():
        table = word_table()
        return lambda texts: {"key": shingles(texts, table)[1]}

    keyed = map_texts(mine.withColumn("whole", F.col("text")), ["node", "whole"], "text", make, "key binary")
    return keyed.where(F.col("node") == F.col("key")).select("node", F.col("whole").alias("text")).dropDuplicates(["node"])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id is the smallest of its class."""
    dropped = classes(docs, id_col, text_col).where(~F.col("id").eqNullSafe(F.col("class_id"))).select("id")
    return docs.join(dropped, docs[id_col].eqNullSafe(dropped["id"]), "left_anti")

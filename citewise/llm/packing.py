"""Packing of documents into sequences by non-negative least squares.

Each document is tokenized once and cut into full windows and a rest; all that is kept
of a piece is its length and the checksum of its ids. Only the histogram of lengths
(one count for each length up to the window) comes to the driver. There, shallow
combinations of one, two or three lengths that fill a window are enumerated, how often
to repeat each is solved against the histogram by non-negative least squares, and the
counts are rounded. What is left is packed greedily by length. The plan is a short table
(length, ranks) -> (sequences, offset); its size depends on the window, not on the data.
Pieces are numbered within their length, and each looks up its place.

A sequence is padded to the window, unless its length is a power of two.

Defined results: a NULL or empty text is its end id alone. Rows that repeat are packed
each; the numbering goes by id, start and checksum, then arbitrarily among equal pieces.
An empty table gives no rows.
"""

from __future__ import annotations

import json
import math
import zlib
from itertools import chain

import numpy as np
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, stored, sums
from .pretokens import class_runs, pretokens

WINDOW = 1024


def byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself, and the others, in their
    order, as the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_ranks(tokenizer: str) -> dict[bytes, int]:
    """Bytes of each token to its id, from a tokenizers file. Pairs that merge must merge in
    the order of their ids, and nothing but the byte-level cut may come before."""
    with open(tokenizer, encoding="utf-8") as file:
        whole = json.load(file)
    model, cut, symbols = whole["model"], whole["pre_tokenizer"], byte_symbols()
    special = {t["content"] for t in whole["added_tokens"]}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    made = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    fits = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and (cut["type"], cut["add_prefix_space"], cut["use_regex"]) == ("ByteLevel", False, True)
        and whole["normalizer"] is None
        and made == sorted(made)
        and len(vocabulary) == len(made) + 256
    )
    if not fits:
        raise ValueError("only byte-level vocabularies of ordered merges are taken")
    return {bytes(symbols[c] for c in t): i for t, i in vocabulary.items()}


class PretokenIds:
    """Ids of pre-tokens, each distinct one encoded once and kept in one array. It starts
    anew when it holds more than `limit`."""

    def __init__(self, ranks: dict[bytes, int], limit: int = 300_000):
        self.encode = tiktoken._tiktoken.CoreBPE(ranks, {}, r"\s+|\S+").encode_single_piece
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.begins, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each word has."""
        if len(self.index) > self.limit:
            self.clear()
        fresh = list(set(words).difference(self.index))
        found = [self.encode(w.encode()) for w in fresh]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))
        self.begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), "<u4", int(sizes.sum()))])
        rows = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[rows]
        places = np.arange(sizes.sum()) + np.repeat(self.begins[rows] - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[places], sizes


def token_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = 0, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens (and ids) of the pieces of each text."""

    runs, ranks = class_runs(), merge_ranks(tokenizer)

    def make():
        kinds, coder = np.repeat(*runs), PretokenIds(ranks)

        def work(texts):
            out = {c: [] for c in ("row", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * ids)}
            cut = [pretokens(t or "", kinds) for t in texts]
            every, sizes = coder([w for c in cut for w in c])
            ends = np.cumsum(sums(sizes, np.array([len(c) for c in cut], np.int64))).tolist()
            for i, (low, high) in enumerate(zip([0, *ends], ends)):
                tokens = np.append(every[low:high], np.array([end], "<u4"))
                for start in range(0, len(tokens), window):
                    piece = tokens[start : start + window]
                    for c, v in zip(out, (i, start, len(piece), zlib.crc32(piece.tobytes()), len(tokens), *[piece] * ids)):
                        out[c].append(v)
            return out

        return work

    return map_texts(docs, [id_col], text_col, make, "start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * ids, explode=True)


def fills(window: int, spread: int = 6) -> list[tuple[int, ...]]:
    """Combinations of up to three lengths with the sum of the window."""
    found = {(window,)} | {(a, window - a) for a in range(1, window // 2 + 1)}
    for a in range(1, window - 1):
        for step in range(1, spread + 1):
            b = max(1, (window - a) * step // (2 * spread))
            if window - a - b >= 1:
                found.add(tuple(sorted((a, b, window - a - b))))
    return sorted(found)


def nnls(combos: list[tuple[int, ...]], histogram: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """Repeat counts x >= 0 that bring sum(x * combo) near the histogram: coordinate
    descent on the squared error, each coordinate at its best in turn."""
    parts = [[(length, c.count(length)) for length in sorted(set(c))] for c in combos]
    rest = histogram.astype(float).tolist()
    x = [0.0] * len(combos)
    for _ in range(sweeps):
        moved = 0.0
        for j, part in enumerate(parts):
            step = sum(n * rest[length] for length, n in part) / sum(n * n for _, n in part)
            step = max(step, -x[j])
            if step:
                x[j] += step
                moved += abs(step)
                for length, n in part:
                    rest[length] -= n * step
        if moved < 0.5:
            break
    return np.array(x)


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that use up the histogram."""
    left = histogram.astype(np.int64).copy()
    combos = fills(window)
    out = []
    repeats = nnls(combos, left)
    for j in np.argsort(-repeats, kind="stable").tolist():
        combo = combos[j]
        n = min(round(repeats[j]), *(int(left[length]) // combo.count(length) for length in combo))
        if n > 0:
            out.append((combo, n))
            for length in combo:
                left[length] -= n
    while left.any():
        pattern, gap, free = [], window, left.copy()
        while gap > 0 and len(fit := np.flatnonzero(free[: gap + 1])):
            length = int(fit[-1])
            times = min(gap // length, int(free[length]))
            pattern += [length] * times
            free[length] -= times
            gap -= length * times
        n = min(int(left[length]) // pattern.count(length) for length in set(pattern))
        out.append((tuple(pattern), n))
        for length in pattern:
            left[length] -= n
    return out


def places(planned: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: from which rank on, the first sequence there, and the offset."""
    table: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, n in planned:
        offset = 0
        for length in pattern:
            table.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + n
            offset += length
        sequence += n
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows)) for length, rows in table.items()}


def ranked(pieces: DataFrame, id_col: str) -> DataFrame:
    """Numbers the pieces of a length from 0. A length that many pieces share is dealt
    into buckets: about the square root of all pieces, so that neither a bucket nor the
    list of buckets grows large."""
    buckets = max(1, math.isqrt(pieces.count()))
    key = F.pmod(F.xxhash64(id_col, "start", "ids_crc32"), F.lit(buckets))
    dealt = pieces.withColumn("_bucket", key)
    counts = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy(id_col, "start", "ids_crc32")
    numbered = dealt.withColumn("_at", F.row_number().over(within) - 1)
    return numbered.join(counts, ["length", "_bucket"]).withColumn("_rank", F.col("_at") + F.col("_before")).drop("_bucket", "_at", "_before")


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    pieces = stored(token_pieces(docs, tokenizer, window, end, id_col, text_col), "pieces")
    histogram = np.zeros(window + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        histogram[length] = n
    table = places(plan(histogram, window))
    fields = [f"`{id_col}` {pieces.schema[id_col].dataType.simpleString()}", "start long", "length long", "ids_crc32 long", "doc_tokens long", "sequence_id long", "offset long"]
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]

    def place(frames):
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["_rank"].to_numpy()
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            for value in np.unique(length).tolist():
                mine = np.flatnonzero(length == value)
                begin, first, shift = table[value]
                at = np.searchsorted(begin, rank[mine], "right") - 1
                sequence[mine] = first[at] + rank[mine] - begin[at]
                offset[mine] = shift[at]
            yield frame[names].assign(sequence_id=sequence, offset=offset)

    return ranked(pieces, id_col).mapInPandas(place, ", ".join(fields))

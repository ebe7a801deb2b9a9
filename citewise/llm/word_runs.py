"""Periodic runs of words: Lyndon groups by the first phase of a suffix sorter, then runs.

A run is a stretch of consecutive words with smallest period q that no neighbouring
word extends keeping q. Found are all runs with at least `min_exponent` periods and
`min_length` words. In each of two opposite orders of the words, the grouping phase of
Baier's suffix sorter puts positions into one group when the longest Lyndon words that
start there are equal, and knows that word's length. In a run the Lyndon roots follow
one another, all in one group in one of the orders; a chain of equal neighbours is
therefore extended to both sides, by less than one period, as far as the words agree.

Before that a word that occurs fewer than `min_exponent` times in its stretch cuts the
stretch there, over and over: a run holds each of its words at least that often, so none
is lost, and of ordinary text little is left to sort.

Each text is worked on by itself and whole, so nothing is shuffled; memory goes with the
longest text. NULL and empty texts have no words, no runs and an empty collapsed text.
Repeated rows give repeated rows; an empty table gives none. Of other columns only those
named in `keep` are read, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import ranges, small_batches

RUNS = "array<struct<start: long, length: long, period: long>>"


def lyndon_groups(ranks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each position the group and length of the longest Lyndon word that starts there.

    Groups are kept in a list ordered by their words and handled from the highest to the
    lowest. A member's nearest position to the left in a lower group moves into a new
    group right above its old one: its word now ends with the member's word, as often
    as members share it. What is handled never moves again.
    """
    n = len(ranks)
    values = sorted(set(ranks))
    group_of = dict(zip(values, range(len(values))))
    group = [group_of[r] for r in ranks]
    members: list[list[int]] = [[] for _ in values]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(values)
    below = list(range(-1, len(values) - 1))
    above = list(range(1, len(values) + 1))
    left = [-1] * n
    handled = bytearray(n)
    g = len(values) - 1
    while g >= 0:
        shared: dict[int, int] = {}
        for s in members[g]:
            if group[s] != g:  # moved up since
                continue
            p = s - 1
            while p >= 0 and handled[p]:
                p = left[p]
            left[s] = p
            handled[s] = 1
            if p >= 0:
                shared[p] = shared.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, times in shared.items():
            moved.setdefault((times, group[p]), []).append(p)
        # Of one old group those followed more often are the higher ones.
        for times, old in sorted(moved, reverse=True):
            new = len(length)
            length.append(length[old] + times * length[g])
            members.append(moved[times, old])
            for p in moved[times, old]:
                group[p] = new
            over = above[old]
            above.append(over)
            below.append(old)
            above[old] = new
            below[over] = new
        g = below[g]
    groups = np.array(group, np.int64)
    return groups, np.array(length, np.int64)[groups] if n else groups


def _agreeing(words: np.ndarray, low: int, high: int, shift: int, backwards: bool) -> int:
    """How many words from one end of [low, high) equal those `shift` further on."""
    differ = np.flatnonzero(words[low:high] != words[low + shift : high + shift])
    if not len(differ):
        return high - low
    return high - low - 1 - int(differ[-1]) if backwards else int(differ[0])


def runs_of(words: np.ndarray, min_exponent: int, min_length: int) -> list[tuple[int, int, int]]:
    """All (start, length, period) of one sequence of word numbers, by start, then period."""
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    n = len(words)
    found = set()
    _, ranks = np.unique(words, return_inverse=True)
    for order in (ranks, -ranks):
        group, size = lyndon_groups(order.tolist())
        at = np.arange(n)
        follows = np.zeros(n, bool)  # the same Lyndon word comes right after
        inside = at + size < n
        follows[inside] = group[at[inside]] == group[at[inside] + size[inside]]
        first = np.ones(n, bool)  # and doesn't come right before
        before = at - size >= 0
        first[before] = group[at[before]] != group[at[before] - size[before]]
        # A run of e periods holds e - 1 whole roots at least.
        chained = first & follows if min_exponent > 2 else first
        for i in np.flatnonzero(chained).tolist():
            period, end = int(size[i]), i + int(size[i])
            while end < n and group[end] == group[i]:
                end += period
            if end - i < (min_exponent - 1) * period:
                continue
            start = i - _agreeing(words, max(0, i - period + 1), i, period, True)
            end += _agreeing(words, end - period, min(n, end + period - 1) - period, period, False)
            if end - start >= max(min_length, min_exponent * period):
                found.add((start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(text: np.ndarray, words: np.ndarray, min_exponent: int, min_length: int):
    """(first, last) positions, both inclusive, of the stretches that may hold runs.

    `text` numbers the text that each word belongs to, ascending.
    """
    at, part, words = np.arange(len(words)), text, words.astype(np.int64)
    while len(at):
        key = part * (int(words.max()) + 1) + words
        _, place, often = np.unique(key, return_inverse=True, return_counts=True)
        stays = often[place] >= min_exponent
        at, part, words = at[stays], part[stays], words[stays]
        opens = np.ones(len(at), bool)
        opens[1:] = (np.diff(at) != 1) | (np.diff(part) != 0)
        part = np.cumsum(opens) - 1
        long = np.bincount(part)[part] >= min_length
        if stays.all() and long.all():
            break
        at, part, words = at[long], part[long], words[long]
    opens = np.flatnonzero(np.diff(part, prepend=-1))
    return at[opens], at[np.append(opens[1:], len(at)) - 1] if len(at) else at


def loop_words(words: list, number: int) -> list:
    """The words with the tail from a = number % n on replaced by repeats of its first
    1 + (n - a) // (3 + number % 8) words; for planting runs."""
    n = len(words)
    if not n:
        return words
    a = number % n
    tail = words[a : a + 1 + (n - a) // (3 + number % 8)]
    return words[:a] + (tail * -(-(n - a) // len(tail)))[: n - a]


def runs_in_texts(texts: list[str], loops: list, min_exponent: int, min_length: int):
    """(number of words, runs, collapsed text) of each text. In the collapsed text a run's
    words after its first period are left out, and one space joins the rest."""
    # bytes.split() cuts at exactly space and \t to \r.
    split = [t.encode().split() for t in texts]
    split = [w if g is None else loop_words(w, g) for w, g in zip(split, loops)]
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64)
    sizes = [len(words) for words in split]
    begins = np.cumsum([0, *sizes])
    runs: list[list] = [[] for _ in texts]
    owner = np.repeat(np.arange(len(texts)), sizes)
    for first, last in zip(*stretches(owner, ids, min_exponent, min_length)):
        of = owner[first]
        shift = int(first - begins[of])
        for start, length, period in runs_of(ids[first : last + 1], min_exponent, min_length):
            runs[of].append((start + shift, length, period))
    collapsed = []
    for words, found in zip(split, runs):
        if found:
            stays = np.ones(len(words), bool)
            for start, length, period in found:
                stays[start + period : start + length] = False
            words = [words[i] for i in np.flatnonzero(stays).tolist()]
        collapsed.append(b" ".join(words).decode())
    return sizes, runs, collapsed


def word_runs(
    frame: DataFrame,
    keep: list[str],
    text: str = "text",
    looped: Column | None = None,
    min_exponent: int = 4,
    min_length: int = 6,
) -> DataFrame:
    """The columns named in `keep`, n_words, runs (by start, then period) and collapsed.

    Words are numbered from 0. Where `looped` is not NULL, the text's words are first
    changed by `loop_words` with that number.
    """
    small_batches(frame.sparkSession)
    names = [f"_k{i}" for i in range(len(keep))]
    loop = (F.lit(None) if looped is None else looped).cast("long").alias("_loop")
    source = frame.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), loop, F.col(text).alias("_text"))
    schema = T.StructType(
        [T.StructField(c, source.schema[n].dataType) for c, n in zip(keep, names)]
        + T._parse_datatype_string(f"n_words long, runs {RUNS}, collapsed string").fields
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(len(names) + 1).to_pylist()]
            loops = batch.column(len(names)).to_pylist()
            for low, high in ranges(texts):
                sizes, runs, collapsed = runs_in_texts(texts[low:high], loops[low:high], min_exponent, min_length)
                rows = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
                kept = batch.slice(low, high - low)
                columns = [kept.column(i).cast(arrow.field(i).type) for i in range(len(names))]
                columns += [pa.array(v, arrow.field(len(names) + i).type) for i, v in enumerate((sizes, rows, collapsed))]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """Of an array of runs the one with the most periods; the first of equal ones."""
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    more = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | more(best, r), r).otherwise(best))

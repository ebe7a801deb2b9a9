"""Pre-tokens of byte-level vocabularies, cut by character class on whole arrays.

The cut is that of the pattern
's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import regex

from .common import code_points

SPACE, LETTER, NUMBER, OTHER = range(4)


def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    valid = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, valid))
    at = np.array(valid, np.int64)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            table[at[m.start() : m.end()]] = kind
    return table


@lru_cache(1)
def class_runs() -> tuple[np.ndarray, np.ndarray]:
    """The same in short, to be sent to tasks: each run of one class, and its length."""
    table = classes()
    begins = np.flatnonzero(np.concatenate([[True], table[1:] != table[:-1]]))
    return table[begins], np.diff(np.append(begins, len(table)))


def pretokens(text: str, table: np.ndarray) -> list[str]:
    if not text:
        return []
    points = code_points(text)
    kind = table[points]
    n = len(kind)
    cut = np.ones(n + 1, bool)
    cut[1:n] = kind[1:] != kind[:-1]
    # Of white space before something else, the last character stands alone, and a plain
    # space goes with what follows.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE))
    cut[last] = True
    cut[last[points[last] == 32] + 1] = False
    # A contraction is an apostrophe that begins a token of its own, then its letters.
    quote = np.flatnonzero(points == 39)
    quote = quote[cut[quote] & (quote + 1 < n)]
    for i in quote[kind[quote + 1] == LETTER].tolist():
        after = text[i + 1 : i + 3]
        size = 1 if after[0] in "stmd" else 2 if after in ("re", "ve", "ll") else 0
        if size:
            cut[i + 1] = False
            cut[i + 1 + size] = True
    edges = np.flatnonzero(cut).tolist()
    return [text[a:b] for a, b in zip(edges, edges[1:])]

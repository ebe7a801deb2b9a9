"""Token counts under a unigram model, by dynamic programming in a trie.

The pre-tokens of a chunk of texts go into a trie of bytes. A node holds the best
(forward) score of a segmentation of the bytes that lead to it, and how many tokens that
has. Scores of a shared prefix are computed once; the node where a pre-token ends holds
its count. Pieces are those of a ranked byte vocabulary; the piece of rank r has the
log-probability -log(r + 2) up to a constant (Zipf's law), which favours frequent pieces
and few of them.

Defined results: NULL and empty texts have 0 pre-tokens, 0 tokens and score 0. Equal
scores go to fewer tokens. A byte that has no piece counts as one token, at the score of
a last rank. Rows that repeat, other columns and empty tables pass.
"""

from __future__ import annotations

import base64
import math

import numpy as np
from pyspark.sql import DataFrame

from .common import TokenTable, map_texts, sums
from .pretokens import class_runs, pretokens


def piece_scores(path: str) -> dict[bytes, float]:
    """Piece to log-probability, from a file of lines "base64 rank"."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): -math.log(int(b) + 2) for a, b in map(bytes.split, file)}


class Trie:
    """Forward scores of prefixes. It starts anew beyond `limit` nodes."""

    def __init__(self, scores: dict[bytes, float], limit: int = 600_000):
        self.scores, self.limit = scores, limit
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0)
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best, self.count = [0.0], [0]

    def insert(self, word: bytes) -> tuple[int, float]:
        """Number of tokens and score of a pre-token."""
        child, best, count = self.child, self.best, self.count
        path = [0]
        for depth, byte in enumerate(word, 1):
            key = (path[-1] << 8) | byte
            node = child.get(key)
            if node is None:
                before = path[-1]
                top = (best[before] + self.scores.get(word[depth - 1 : depth], self.unknown), -count[before] - 1)
                for start in range(max(0, depth - self.longest), depth - 1):
                    if (score := self.scores.get(word[start:depth])) is not None:
                        top = max(top, (best[path[start]] + score, -count[path[start]] - 1))
                node = child[key] = len(best)
                best.append(top[0])
                count.append(-top[1])
            path.append(node)
        return count[path[-1]], best[path[-1]]

    def terminals(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts and scores of distinct pre-tokens, best in sorted order."""
        if len(self.best) > self.limit:
            self.clear()
        found = [self.insert(w.encode()) for w in words]
        return np.array([n for n, _ in found], np.int64), np.array([s for _, s in found], float)


def count_tokens(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_pretokens, n_tokens, score of every text."""
    runs = class_runs()

    def make():
        kinds = np.repeat(*runs)
        table = TokenTable(Trie(piece_scores(ranks_path)).terminals)

        def work(texts):
            cut = [pretokens(t or "", kinds) for t in texts]
            flat = [w for c in cut for w in c]
            sizes = np.array([len(c) for c in cut], np.int64)
            rows = table.rows(flat)
            n, score = table.values if table.values else (np.zeros(0, np.int64), np.zeros(0))
            return {"n_pretokens": sizes, "n_tokens": sums(n[rows], sizes), "score": sums(score[rows], sizes)}

        return work

    return map_texts(docs, [id_col], text_col, make, "n_pretokens long, n_tokens long, score double")

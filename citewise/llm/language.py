"""Language identification in two steps: the family first, then the language within it.

A text is the relative frequency of its hashed letter sequences (one to three letters of
a word with its edges). Linear support vector machines, one for each pair, choose among
families, and then, within the chosen family, among its languages. Most votes win; ties
go to the larger sum of margins, then to the first name. The contribution of a word to
all machines is computed once for each distinct word of a task.

The machines are fitted on the driver to a bounded sample: about `per_language` labelled
rows of each language and `most_rows` in all, chosen by a hash of the id. Everything else
runs over all rows and whole texts.

Defined results: a NULL text, and one without a letter, is "und" with score 0. With one
language in the labels everything else is that language; without labels it is "und".
Labels that are NULL are ignored. Rows that repeat are judged each. An empty table gives no
rows. Texts of any length are judged whole, in a chunk of their own beyond a million
characters. Columns other than the named ones play no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TokenTable, code_points, map_texts, mix

DIMENSIONS, PER_LANGUAGE, MOST_ROWS = 4096, 400, 4000

# Families of common language codes. Other codes are families of their own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr"),
}


def family(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang in codes), lang)


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed letter sequences of all words, and how many each word has."""
    points = code_points("".join(f" {w} " for w in words)).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    end = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(points))
    hashes, owners = [], []
    code = np.zeros(len(points), np.uint64)
    for n in (1, 2, 3):
        code = code[: len(points) - n + 1] * np.uint64(1 << 21) + points[n - 1 :]
        inside = at[: len(code)] + n <= end[: len(code)]
        if n == 1:
            inside &= points != 32
        hashes.append((mix(code[inside] + np.uint64(n)) % np.uint64(DIMENSIONS)).astype(np.int64))
        owners.append(np.repeat(np.arange(len(words)), sizes)[: len(code)][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(hashes)[order], np.bincount(owner, minlength=len(words))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def frequencies(texts: list[str | None]) -> np.ndarray:
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for i, text in enumerate(texts):
        if words := words_of(text):
            out[i] = np.bincount(ngrams(words)[0], minlength=DIMENSIONS)
            out[i] /= out[i].sum()
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 10.0, epochs: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine by dual coordinate descent."""
    x = np.concatenate([x, np.full((len(x), 1), 0.1)], 1)
    norms = (x * x).sum(1)
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(x)):
            new = min(penalty, max(0.0, alpha[i] - (y[i] * (x[i] @ w) - 1) / norms[i]))
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w[:-1], float(w[-1] * 0.1)


@dataclass
class Model:
    """Duels (first, second) with weights; positive margins are for the first."""

    languages: list[str]
    families: list[str]
    duels: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray

    def winner(self, names: list[str], margin: np.ndarray) -> tuple[str, float]:
        """The name with most duels won, and its least margin."""
        if len(names) == 1:
            return names[0], np.inf
        won = dict.fromkeys(names, 0)
        total, least = dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
        for (a, b), m in zip(self.duels, margin):
            if a in won and b in won:
                won[a if m > 0 else b] += 1
                total[a] += m
                total[b] -= m
                least[a], least[b] = min(least[a], m), min(least[b], -m)
        name = min(names, key=lambda c: (-won[c], -total[c], c))
        return name, least[name]

    def predict(self, margin: np.ndarray) -> tuple[str, float]:
        fam, one = self.winner(self.families, margin)
        lang, two = self.winner([x for x in self.languages if f"={family(x)}" == fam], margin)
        least = min(one, two)
        return lang, 1.0 if least == np.inf else float(1 / (1 + np.exp(-3 * least)))


def sample(labelled: DataFrame, id_col: str, lang_col: str, per_language: int, most_rows: int) -> DataFrame:
    """About so many rows of each language, by a hash of the id: bounded."""
    counts = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().collect()}
    each = min(per_language, max(1, most_rows // max(1, len(counts))))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col(lang_col) == lang, min(1.0, each / n)).otherwise(share)
    return labelled.where((F.pmod(F.xxhash64(F.lit(7), id_col), F.lit(1 << 40)) / float(1 << 40)) < share)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> Model:
    labelled = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    chosen = sample(labelled, id_col, lang_col, per_language, most_rows)

    def make():
        return lambda texts: {"x": [f.tobytes() for f in frequencies(texts)]}

    rows = map_texts(chosen, [lang_col], text_col, make, "x binary").collect()
    langs = sorted({r[0] for r in rows})
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]).astype(float) if rows else np.zeros((0, DIMENSIONS))
    # Frequencies as square roots, so that rare sequences have a say, at unit length.
    x = np.sqrt(x)
    lang = np.array([r[0] for r in rows])
    fam = np.array([f"={family(v)}" for v in lang])
    duels, weights, bias = [], [], []
    for names, of in [(sorted(set(fam)), fam)] + [([v for v in langs if f"={family(v)}" == f], lang) for f in sorted(set(fam))]:
        for a, b in combinations(names, 2):
            mine = (of == a) | (of == b)
            w, c = fit_svm(x[mine], np.where(of[mine] == a, 1.0, -1.0))
            duels.append((a, b))
            weights.append(w)
            bias.append(c)
    return Model(langs, sorted(set(fam)), duels, np.array(weights).reshape(-1, DIMENSIONS), np.array(bias))


def identify(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """The id columns, lang_pred and score of every text."""

    def make():
        def compute(words):
            hashes, n = ngrams(words)
            # A word as its hashed sequences: row pointers into one array.
            out = np.empty(len(words), object)
            out[:] = np.split(hashes, np.cumsum(n)[:-1])
            return (out,)

        table = TokenTable(compute, 150_000)

        def work(texts):
            cut = [words_of(t) for t in texts]
            rows, at = table.rows([w for c in cut for w in c]), 0
            langs, scores = [], []
            for text, words in zip(texts, cut):
                mine = rows[at : at + len(words)]
                at += len(words)
                if not words or not model.languages or not any(map(str.isalpha, text)):
                    langs.append("und")
                    scores.append(0.0)
                    continue
                n = np.bincount(np.concatenate(table.values[0][mine]), minlength=DIMENSIONS)
                lang, score = model.predict(model.weights @ np.sqrt(n / n.sum()) + model.bias)
                langs.append(lang)
                scores.append(score)
            return {"lang_pred": langs, "score": scores}

        return work

    return map_texts(docs, id_cols, text_col, make, "lang_pred string, score double")

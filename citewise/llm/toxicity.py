"""Toxicity by weak supervision.

Many voters look at a text: lexicons of words and of word beginnings, mined from one half
of a bounded sample of labelled rows and split among voters, and patterns of writing. On
the other half, whose labels it never sees, a generative label model estimates from the
votes alone how often each voter is right (expectation maximization, started from the
voters' record on the first half) and which voters depend on each other once the label
is known; what dependent voters say together counts less. Its posterior labels of the whole sample
train a sparse linear classifier over words and word beginnings, which scores every whole
text.

The sample: about `rows` labelled rows of each class, chosen by a hash of the id; their
ids may be broadcast. Of near copies among them (with the same lowest hash of a run of five
words, three hashes in turn) one counts: what a family repeats is no sign. Their texts stay in tasks: features are counted there, class by
class, and what reaches the driver are votes, a dictionary of at most `most_features`
features and the sample's counts of those, so a text may be of any length.

Defined results: NULL and empty texts have the classifier's score of no features. Without
labelled rows of both classes every score is 0. Rows that repeat are scored each; labels
that are NULL or neither 0 nor 1 are ignored, and of several labels of an id the higher
counts. An empty table gives no rows. Columns other than the named ones play no part; the
score's name is a parameter, for tables that have such a column.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TokenTable, map_texts, mix, small_batches, stored, sums
from .near_dedup import shingles, word_table

ROWS, MOST_FEATURES, LEXICONS = 2000, 20_000, 6


def features(token: str) -> list[str]:
    """The word of a token and its beginnings."""
    word = token.strip("\"'.,;:!?()[]{}<>|*_-#~«»“”„…").lower()
    if not word:
        return []
    return [f"w:{word}", *(f"b{n}:{word[:n]}" for n in (4, 5, 6) if len(word) > n)]


def patterns(text: str) -> list[int]:
    """Votes of writing patterns: 1 toxic, -1 clean, 0 none."""
    n = max(1, len(text))
    loud = text.count("!") / n
    upper = sum(map(str.isupper, text)) / n
    return [1 if loud > 0.02 else 0, 1 if upper > 0.3 else 0, -1 if loud == 0 and upper < 0.1 else 0]


@dataclass
class LabelModel:
    """P(vote | label) of each voter, how much voters overlap, and the share of toxic."""

    rates: np.ndarray
    weight: np.ndarray
    prior: float

    @staticmethod
    def fit(votes: np.ndarray, start: np.ndarray | None = None, rounds: int = 25) -> LabelModel:
        """votes: rows x voters of -1, 0, 1. start: the first posterior of each row; without
        it the majority of its votes, voters being right more often than not."""
        if start is None:
            start = 1 / (1 + np.exp(-np.clip(votes.sum(1), -4, 4)))
        shown = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float)
        post, weight = start.astype(float), np.ones(votes.shape[1])
        model = LabelModel(np.zeros((2, votes.shape[1], 3)), weight, 0.5)
        for _ in range(rounds):
            prior = float(np.clip(post.mean(), 0.01, 0.99))
            rates = []
            for p in (1 - post, post):
                n = np.einsum("r,rvk->vk", p, shown) + 0.1
                rates.append(n / n.sum(1, keepdims=True))
            rates = np.array(rates)
            # What is left of the votes once the label is known; where two voters' rests
            # go together they say the same thing twice.
            expected = np.einsum("ry,yv->rv", np.stack([1 - post, post], 1), rates[:, :, 2] - rates[:, :, 0])
            rest = votes - expected
            norm = np.sqrt((rest * rest).sum(0)) + 1e-9
            correlation = np.abs((rest / norm).T @ (rest / norm))
            weight = 1 / np.maximum(1.0, correlation.sum(0))
            model = LabelModel(rates, weight, prior)
            new = model.posterior(votes)
            if np.abs(new - post).max() < 1e-4:
                break
            post = new
        return model

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        shown = np.stack([votes == v for v in (-1, 0, 1)], 2)
        said = np.log(self.rates[1] / self.rates[0])
        logit = np.log(self.prior / (1 - self.prior)) + (np.where(shown, said, 0.0).sum(2) * self.weight).sum(1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def deal_lexicons(marks: list[str], voters: int = LEXICONS) -> list[set[str]]:
    """Marks of toxic rows, the most frequent first, dealt to voters: words and beginnings
    apart."""
    out = []
    for kind in ("w", "b"):
        own = [f for f in marks if f[0] == kind]
        out += [set(own[i::voters]) for i in range(voters)]
    return out


def cast_votes(found: set[str], text: str, lexicons: list[set[str]]) -> list[int]:
    hits = [1 if found & lexicon else 0 for lexicon in lexicons]
    return [*hits, *patterns(text), 0 if any(hits) else -1]


def features_of(text: str) -> Counter:
    """In how many distinct tokens of a text each feature is found."""
    return Counter(f for token in set(text.split()) for f in features(token))


def fit_linear(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, shape: tuple[int, int], y: np.ndarray, l1: float = 3e-3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Sparse logistic regression on soft labels by accelerated proximal gradient. The
    columns are brought to unit mean square first."""
    n, d = shape
    scale = np.sqrt(np.maximum(np.bincount(columns, values * values, d), 1e-9) / n)
    values = values / scale[columns]
    w, b = np.zeros(d), 0.0
    u = np.ones(d)
    for _ in range(20):
        u = np.bincount(columns, values * np.bincount(rows, values * u[columns], n)[rows], d)
        size = float(np.sqrt(u @ u)) or 1.0
        u = u / size
    rate = 4.0 * n / (size + n)
    v, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        z = np.bincount(rows, values * v[columns], n) + vb
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        new = v - rate * np.bincount(columns, values * err[rows], d)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        new_b = vb - rate * err.sum()
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    return w / scale, b


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -np.inf
    labels: LabelModel | None = None
    lexicons: list[set[str]] = field(default_factory=list)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = ROWS, most_features: int = MOST_FEATURES) -> Model:
    """Voters, label model, then the classifier on posterior labels."""
    labels = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and id is not null").groupBy("id").agg(F.max("y").alias("y"))
    counts = {r[0]: r[1] for r in labels.groupBy("y").count().collect()}
    if len(counts) < 2:
        return Model()
    share = F.when(F.col("y") == 1, min(1.0, rows / counts[1])).otherwise(min(1.0, rows / counts[0]))
    chosen = labels.where((F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 40)) / float(1 << 40)) < share)
    mine = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    # Of several texts of an id the one with the smallest hash, so the sample stays bounded.
    mine = mine.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    mine = _lowest_runs(mine)
    for run in ("run0", "run1", "run2"):
        mine = mine.groupBy("y", run).agg(F.min(F.struct("id", "text", "run0", "run1", "run2")).alias("row")).select("y", "row.*")
    half = F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(2)).cast("int")
    sample = stored(mine.select("id", "y", half.alias("half"), "text"), "toxicity-sample")

    seen = {(r["half"], r["y"]): r["count"] for r in sample.groupBy("half", "y").count().collect()}
    n0, n1 = (seen.get((0, y), 0) for y in (0, 1))
    marks = _feature_counts(sample.where("half = 0"), "y", {0: 0.0, 1: 1.0}).where("toxic >= 4")
    marks = marks.where((F.col("toxic") + 0.5) / max(1, n1) > 20 * (F.col("n") - F.col("toxic") + 0.5) / max(1, n0))
    marks = marks.orderBy(F.desc("toxic"), "feature").limit(most_features).collect()
    lexicons = deal_lexicons([r["feature"] for r in marks])
    found = _votes(sample, lexicons).collect()
    if not found:
        return Model()
    votes = np.array([r["votes"] for r in found], np.int64)
    unseen = np.array([r["half"] for r in found]) == 1
    y = np.array([r["y"] for r in found], float)
    record = LabelModel.fit(votes[~unseen], y[~unseen], rounds=1) if 0 < y[~unseen].sum() < (~unseen).sum() else None
    start = record.posterior(votes[unseen]) if record else None
    model = LabelModel.fit(votes[unseen], start) if unseen.any() else LabelModel.fit(votes)
    soft = model.posterior(votes)

    # Features that tell the posterior labels apart; the rest would only add noise that
    # grows with the length of a text.
    n, total = len(found), float(soft.sum())
    tells = _feature_counts(sample, "id", dict(zip([r["id"] for r in found], soft.tolist()))).where("n >= 4")
    odds = (F.col("toxic") + 0.5) / (total + 1) * (n - total + 1) / (F.col("n") - F.col("toxic") + 0.5)
    tells = tells.where((odds > 20) | (odds < 1 / 20)).orderBy(F.desc("n"), "feature").limit(most_features).collect()
    index = {r["feature"]: i for i, r in enumerate(tells)}
    place = {r["id"]: i for i, r in enumerate(found)}
    cells = _cells(sample, index).toArrow().combine_chunks()
    columns, values = (cells[c].combine_chunks() for c in ("columns", "values"))
    sizes = columns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows_of = np.repeat(np.array([place[i] for i in cells["id"].to_pylist()], np.int64), sizes)
    at, times = columns.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy().astype(float)
    w, b = fit_linear(rows_of, at, times, (n, len(index)), soft)
    return Model({f: float(w[i]) for f, i in index.items() if w[i]}, float(b), model, lexicons)


def _lowest_runs(rows: DataFrame) -> DataFrame:
    """Adds three lowest hashes of a run of five words: near copies mostly share them."""

    def make():
        table = word_table()
        seeds = mix(np.arange(1, 4, dtype=np.uint64))

        def work(texts):
            lowest = np.array([[mix(r ^ s).min(initial=0xFFFFFFFFFFFFFFFF) for s in seeds] for r in shingles(texts, table)[0]], np.uint64)
            return {f"run{i}": lowest[:, i].view(np.int64) if len(lowest) else [] for i in range(3)}

        return work

    kept = rows.select("id", "y", F.col("text").alias("whole"), "text")
    found = map_texts(kept, ["id", "y", "whole"], "text", make, "run0 long, run1 long, run2 long")
    return found.withColumnRenamed("whole", "text")


def _feature_counts(sample: DataFrame, key: str, toxic: dict) -> DataFrame:
    """(feature, n, toxic): the rows that hold a feature, and the sum of toxic[key] over
    them. Tasks add up their rows first."""

    def run(batches):
        total: dict[str, list[float]] = {}
        for batch in batches:
            for own, text in zip(batch.column(key).to_pylist(), batch.column("text").to_pylist()):
                share = toxic[own]
                for f in features_of(text):
                    held = total.setdefault(f, [0, 0.0])
                    held[0] += 1
                    held[1] += share
        if total:
            n, shares = zip(*total.values())
            columns = [pa.array(list(total), pa.string()), pa.array(n, pa.int64()), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["feature", "n", "toxic"])

    small_batches(sample.sparkSession)
    parts = sample.select(key, "text").mapInArrow(run, "feature string, n long, toxic double")
    return parts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def _votes(sample: DataFrame, lexicons: list[set[str]]) -> DataFrame:
    def make():
        return lambda texts: {"votes": [cast_votes(set(features_of(t)), t, lexicons) for t in texts]}

    return map_texts(sample, ["id", "y", "half"], "text", make, "votes array<int>")


def _cells(sample: DataFrame, index: dict[str, int]) -> DataFrame:
    """For each row the kept features it holds, and in how many tokens."""

    def make():
        def work(texts):
            held = [{index[f]: n for f, n in features_of(t).items() if f in index} for t in texts]
            return {"columns": [list(h) for h in held], "values": [list(h.values()) for h in held]}

        return work

    return map_texts(sample, ["id"], "text", make, "columns array<int>, values array<int>")


def score(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """The id columns and the score (0 to 1) of every text, under the given name."""

    def make():
        weights = model.weights

        def compute(tokens):
            return (np.array([sum(weights.get(f, 0.0) for f in features(t)) for t in tokens]),)

        table = TokenTable(compute)

        def work(texts):
            cut = [list(set((t or "").split())) for t in texts]
            sizes = np.array([len(c) for c in cut], np.int64)
            rows = table.rows([w for c in cut for w in c])
            values = table.values[0][rows] if len(rows) else np.zeros(0)
            logit = sums(values, sizes) + model.bias
            return {name: 1 / (1 + np.exp(-np.clip(logit, -500, 500)))}

        return work

    return map_texts(docs, id_cols, text_col, make, f"`{name}` double")

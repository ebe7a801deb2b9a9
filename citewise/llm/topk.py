"""Exact top-k search by inner product: global score histograms, refined step by step.

Vectors are packed into blocks; every pair of a query block and a candidate block is
scored in one task row. A pass counts the scores of each query in bins of its current
range. A block reports only its uppermost bins, down to its own k-th score: the global
k-th score is never below that, so the counts of the bins above it are complete. The bin
that holds the k-th score becomes the next range, until it is one score wide. The last
pass keeps scores above the k-th, and of those equal to it the smallest identifiers.

Defined results: vectors that are NULL, empty of numbers, or hold a NULL or non-finite
component take no part, nor do rows without an identifier, which nothing could name; only
vectors of equal length are compared. Identifiers are 64-bit integers throughout. Rows that repeat an
identifier are candidates each; of such queries the smallest vector asks. A query with fewer candidates gets all of them. Scores
are exact while they fit a 64-bit integer.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Rows of a block of candidates and of queries; bins of a histogram.
CANDIDATE_ROWS, QUERY_ROWS, BINS = 4096, 1024, 256


def whole_vectors(frame: DataFrame, id_col: str, vector_col: str, scale: float = 64.0) -> DataFrame:
    """id, vec (floor(scale * x), whole numbers) and dim of the vectors that take part."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        frame.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(x) > 0) & ~bad)
        .select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("vec"))
        .withColumn("dim", F.size("vec"))
    )


def blocks(vectors: DataFrame, rows: int, count: int) -> DataFrame:
    """Packs vectors into rows (block, dim, n, ids, data) of at most `rows` vectors."""

    def pack(frames):
        held: dict[int, list[pd.DataFrame]] = {}

        def out(dim):
            frame = pd.concat(held.pop(dim))
            data = np.stack(frame["vec"].to_numpy()).astype(np.int64)
            ids = frame["id"].to_numpy(np.int64)
            block = int(ids[0] ^ (ids[-1] << 7)) % count
            return pd.DataFrame({"block": [block], "dim": [dim], "n": [len(ids)], "ids": [ids.tobytes()], "data": [data.tobytes()]})

        for frame in frames:
            for dim, part in frame.groupby("dim"):
                for low in range(0, len(part), rows):
                    piece = part.iloc[low : low + rows]
                    if dim in held and sum(map(len, held[dim])) + len(piece) > rows:
                        yield out(dim)
                    held.setdefault(dim, []).append(piece)
        for dim in list(held):
            yield out(dim)

    return vectors.mapInPandas(pack, "block int, dim int, n int, ids binary, data binary")


def _scores(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    q = np.frombuffer(row.q_data, np.int64).reshape(-1, row.dim)
    c = np.frombuffer(row.c_data, np.int64).reshape(-1, row.dim)
    exact = float(np.abs(q).max()) * float(np.abs(c).max()) * row.dim < 2**53
    score = (q.astype(float) @ c.T.astype(float)).astype(np.int64) if exact else q @ c.T
    q_ids, c_ids = np.frombuffer(row.q_ids, np.int64), np.frombuffer(row.c_ids, np.int64)
    return score, q_ids, c_ids


def histogram(pairs: DataFrame, k: int) -> DataFrame:
    """(query, bin, n): counts of the uppermost bins of [low, low + span)."""

    def count(frames):
        for frame in frames:
            for row in frame.itertuples():
                score, q_ids, c_ids = _scores(row)
                low = np.frombuffer(row.low, np.int64)
                width = np.frombuffer(row.width, np.int64)
                span = np.frombuffer(row.span, np.int64)
                need = np.frombuffer(row.need, np.int64)
                out = []
                for i, query in enumerate(q_ids):
                    mine = score[i][c_ids != query] - low[i]
                    at = mine[(mine >= 0) & (mine < span[i])] // width[i]
                    n = np.bincount(at, minlength=BINS)[::-1]
                    above = np.cumsum(n) - n
                    bins = np.flatnonzero((n > 0) & (above < need[i]))
                    out.append(np.stack([np.full(len(bins), query), BINS - 1 - bins, n[bins]], 1))
                yield pd.DataFrame(np.concatenate(out), columns=["query", "bin", "n"])

    return pairs.mapInPandas(count, "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))


def _narrowed(bounds: DataFrame, counts: DataFrame) -> DataFrame:
    """The bin of each query that holds the k-th score becomes its range."""
    down = Window.partitionBy("query").orderBy(F.desc("bin"))
    upto = counts.withColumn("upto", F.sum("n").over(down))
    upto = upto.join(bounds, "query").where("upto >= need").groupBy("query").agg(F.max(F.struct("bin", "upto", "n")).alias("b"))
    return bounds.join(upto, "query", "left").select(
        "query",
        # With fewer than k candidates no bin is reached; then everything is wanted.
        F.when(F.col("b").isNull(), F.col("low")).otherwise(F.col("low") + F.col("b.bin") * F.col("width")).alias("low"),
        F.when(F.col("b").isNull(), F.lit(0).cast("long")).otherwise(F.col("width")).alias("span"),
        F.when(F.col("b").isNull(), F.lit(0)).otherwise(F.col("need") - (F.col("b.upto") - F.col("b.n"))).alias("need"),
    )


def top_k(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query, ties to the smaller id.

    vectors: id, vec, dim from whole_vectors. queries: which of them are queries.
    """
    vectors = stored(vectors, "vectors")
    asked = vectors.where(queries).groupBy("id").agg(F.min(F.struct("vec", "dim")).alias("v")).select("id", "v.vec", "v.dim")
    n, most = vectors.agg(F.count(F.lit(1)), F.max(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))).first()
    n_asked = asked.count()
    c_count, q_count = max(1, math.ceil(n / CANDIDATE_ROWS)), max(1, math.ceil(n_asked / QUERY_ROWS))
    spread = math.ceil(n / CANDIDATE_ROWS) or 1
    candidates = stored(blocks(vectors.repartition(spread, "id"), CANDIDATE_ROWS, c_count), "candidates")
    q_blocks = stored(blocks(asked.repartition(q_count, "id"), QUERY_ROWS, q_count), "queries")
    # Every score lies within the product of two lengths; one more for rounding.
    bound = int(min(most or 0.0, 2.0**61)) + 1
    width = -(-(2 * bound + 1) // BINS)
    bounds = asked.select(F.col("id").alias("query")).distinct().select(
        "query", *(F.lit(v).cast("long").alias(c) for c, v in (("low", -bound), ("width", width), ("span", width * BINS), ("need", k)))
    )
    while True:
        cells = _cells(candidates, q_blocks, bounds, c_count, q_count)
        bounds = stored(_narrowed(bounds, histogram(cells, k)), "bounds")
        if width == 1:
            break
        width = -(-width // BINS)
        bounds = bounds.select("query", "low", F.lit(width).cast("long").alias("width"), "span", "need")
    # need: how many of the scores equal to low are wanted; with span 0 all scores are.
    bounds = bounds.withColumn("width", F.lit(1).cast("long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = _above(_cells(candidates, q_blocks, bounds, c_count, q_count), k)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _cells(candidates, q_blocks, bounds, c_count, q_count) -> DataFrame:
    """The grid: each candidate block beside each query block of its length. The query
    blocks carry the ranges of their queries."""

    def put(key, frame, limits):
        by = limits.drop_duplicates("query").set_index("query")
        out = []
        for row in frame.itertuples():
            mine = by.loc[np.frombuffer(row.ids, np.int64)]
            out.append(
                (row.block, row.dim, row.ids, row.data, *(mine[c].to_numpy(np.int64).tobytes() for c in ("low", "width", "span", "need")))
            )
        return pd.DataFrame(out, columns=["q_block", "dim", "q_ids", "q_data", "low", "width", "span", "need"])

    schema = "q_block int, dim int, q_ids binary, q_data binary, low binary, width binary, span binary, need binary"
    unpacked = q_blocks.select("block", "dim", "ids").mapInPandas(_ids, "uid string, query long")
    limits = unpacked.join(bounds, "query")
    named = q_blocks.withColumn("uid", F.md5("ids"))
    ranged = named.groupBy("uid").cogroup(limits.groupBy("uid")).applyInPandas(put, schema)
    left = candidates.select(F.col("block").alias("c_block"), "dim", F.col("ids").alias("c_ids"), F.col("data").alias("c_data")).withColumn(
        "q_block", F.explode(F.sequence(F.lit(0), F.lit(q_count - 1)))
    )
    right = ranged.withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(c_count - 1))))
    return left.join(right, ["c_block", "q_block", "dim"])


def _ids(frames):
    import hashlib

    for frame in frames:
        for ids in frame["ids"]:
            yield pd.DataFrame({"uid": hashlib.md5(ids).hexdigest(), "query": np.frombuffer(ids, np.int64)})


def _above(cells: DataFrame, k: int) -> DataFrame:
    def keep(frames):
        for frame in frames:
            for row in frame.itertuples():
                score, q_ids, c_ids = _scores(row)
                low = np.frombuffer(row.low, np.int64)
                span = np.frombuffer(row.span, np.int64)
                need = np.frombuffer(row.need, np.int64)
                out = []
                for i, query in enumerate(q_ids):
                    other = c_ids != query
                    if span[i] == 0:
                        at = np.flatnonzero(other)
                    else:
                        equal = np.flatnonzero(other & (score[i] == low[i]))
                        equal = equal[np.argsort(c_ids[equal], kind="stable")[: need[i]]]
                        at = np.concatenate([np.flatnonzero(other & (score[i] > low[i])), equal])
                    out.append(np.stack([np.full(len(at), query), c_ids[at], score[i][at]], 1))
                yield pd.DataFrame(np.concatenate(out), columns=["query_id", "vec_id", "score"])

    return cells.mapInPandas(keep, "query_id long, vec_id long, score long")

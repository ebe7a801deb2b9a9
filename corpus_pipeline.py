"""The corpus pipeline: five filters and transformations of documents, in order.

Every stage works on all that the one before kept, whole texts, and all but the last
return the columns of documents, whatever else those are called. Defined results: NULL and
empty texts are scored like any other, count as copies of each other, hold no personal
data and are packed as their end alone. Of exact copies the smallest id stays (a missing id
is the largest; of equal rows the first by file and row), of near copies the smallest id of
the class; there all rows without an id count as one. An empty table gives no rows. What a stage writes stays below
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citewise.llm import exact_dedup, near_dedup, packing, pii, queries, toxicity
from citewise.llm.common import new_folder, new_name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones, doesn't reject."""
    labels = queries.table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    score = new_name(docs, "score")
    return toxicity.score(docs, model, docs.columns, name=score).where(F.col(score) < 0.5).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text the one with the smallest id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the one with the smallest id."""
    return near_dedup.keep_one(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    found = pii.redact(docs, pii.train(pii.labelled_examples()))
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, queries.tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", hide_personal_data),
    ("packing", pack),
]

#: SQL can't express the trained stages; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs

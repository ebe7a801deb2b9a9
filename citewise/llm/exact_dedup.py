"""Exact deduplication by a stateful stream.

Arrivals are compact records (digest, identifier, locator of the content) that go
through keyed state on disk (RocksDB, no watermark, so nothing expires). The state
keeps, for each digest, the smallest identifier, where its content lies, and a count.
Every hit is then checked on its full bytes; where the row that stays came with an earlier
arrival, its text is fetched by the locator. Texts that only share a digest are grouped by
the text itself. DataFrame functions only.

A state folder holds the records of all arrivals and the stream's checkpoint. Later
arrivals sent to the same folder meet all earlier ones; the files they point to must still
be there, and the text must have the same column name in all of them.

Defined results: a NULL text counts as empty; runs of white space count as one space. A
NULL identifier comes after all others. Rows that repeat identifier and text stay one
row each, of which one is kept (the first by file and row). An empty table gives no rows.
Other columns, whatever their names, don't matter. Texts of any length are compared whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import new_folder, new_name, stored

# State on disk; without room set aside in advance, which many small stores would waste.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
WHITE = r"[\x20\x09-\x0D]+"


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Identifier, text and place of each row. docs must come straight from files."""
    return docs.select(
        F.col(id_col).alias("id"),
        normal(F.col(text_col)).alias("text"),
        F.struct(
            F.col(id_col).isNull().alias("no_id"),
            F.col(id_col).alias("id"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ).alias("at"),
    )


def remember(arrivals: DataFrame, folder: str) -> DataFrame:
    """Sends a stream of (digest, at) through the keyed state below folder and returns
    the state: digest, at (of the row that stays), rows."""
    spark = arrivals.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        query = (
            arrivals.groupBy("digest")
            .agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("rows"))
            .writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", folder)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        state = spark.read.format("statestore").load(folder)
        least, rows = state.schema["value"].dataType.names
        return stored(state.select("key.digest", F.col(f"value.{least}").alias("at"), F.col(f"value.{rows}").alias("rows")), "seen")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def assign(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    in_files: bool = False,
    digest: Callable[[Column], Column] = sha256,
    state_folder: str | None = None,
) -> DataFrame:
    """One row for each row of docs: id, at, keep (its id), group_size, kept, digest.

    in_files: docs is a plain scan of files, so that the places of its rows are known;
    other frames are first written to the shared folder.
    """
    spark = docs.sparkSession
    if not in_files:
        docs = stored(docs.select(F.col(id_col), F.col(text_col)), "arrivals")
    rows = located(docs, id_col, text_col)
    folder = state_folder or new_folder(spark, "state")
    own = f"{folder}/arrivals/{uuid.uuid4().hex}"
    rows.select("at", digest(F.col("text")).alias("digest")).write.parquet(own)
    records = spark.read.parquet(own)
    stream = spark.readStream.schema(records.schema).parquet(f"{folder}/arrivals/*")
    state = remember(stream, f"{folder}/checkpoint")

    grouped = records.join(state.withColumnRenamed("at", "keep"), "digest")
    repeated = grouped.where("rows > 1").select("at", "digest", (F.col("at") == F.col("keep")).alias("first"))
    texts = rows.select("at", "text")
    members = stored(texts.join(repeated, "at").select("digest", "at", "first", "text"), "members")
    firsts = members.where("first").select("digest", "at", F.col("text").alias("first_text"))
    if state_folder:
        firsts = firsts.union(_earlier(grouped, firsts, id_col, text_col))
    hits = members.where("not first").join(firsts.drop("at"), "digest")
    unequal = stored(hits.where("text != first_text").select("digest").distinct(), "unequal")
    if not unequal.isEmpty():
        grouped = _regrouped(grouped, members, firsts, unequal)
    return grouped.select(
        F.col("at.id").alias("id"),
        "at",
        F.col("keep.id").alias("keep"),
        F.col("rows").alias("group_size"),
        (F.col("at") == F.col("keep")).alias("kept"),
        "digest",
    )


def _earlier(grouped: DataFrame, firsts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(digest, at, first_text) of rows that stay and came with an earlier arrival."""
    spark = grouped.sparkSession
    missing = grouped.where("rows > 1").select("digest", F.col("keep").alias("at")).distinct().join(firsts, "digest", "left_anti")
    missing = stored(missing, "missing")
    # As many names as files hold such rows.
    files = [r[0] for r in missing.select("at.file").distinct().collect()]
    if not files:
        return firsts.where("false")
    place = ["_file", "_row"]
    there = spark.read.parquet(*files).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"), normal(F.col(text_col)).alias("first_text")
    )
    wanted = missing.select("digest", "at", F.col("at.file").alias("_file"), F.col("at.row").alias("_row"))
    return stored(there.join(wanted, place).select("digest", "at", "first_text"), "earlier")


def _regrouped(grouped, members, firsts, unequal) -> DataFrame:
    """Groups by the text itself where one digest stands for several texts."""
    clash = members.join(unequal, "digest", "left_semi").select("digest", "at", "text")
    known = firsts.join(unequal, "digest", "left_semi").select("digest", "at", F.col("first_text").alias("text"))
    by_text = clash.union(known).distinct().groupBy("digest", "text").agg(F.min("at").alias("keep"), F.count(F.lit(1)).alias("rows"))
    apart = clash.join(by_text, ["digest", "text"]).select("digest", "at", "keep", "rows")
    rest = grouped.join(unequal, "digest", "left_anti").select("digest", "at", "keep", "rows")
    return rest.unionByName(apart)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, a plain scan of files, that stay; its columns."""
    found = assign(docs, id_col, text_col, in_files=True)
    file, row = new_name(docs, "file"), new_name(docs, "row")
    dropped = found.where("not kept").select(F.col("at.file").alias(file), F.col("at.row").alias(row))
    placed = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    return placed.join(dropped, [file, row], "left_anti").select(docs.columns)

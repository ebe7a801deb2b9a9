"""Writes the stand-in tables in the feeds' own file formats, as Spark jobs.

The source queries read these files back, so their work grows with the tables.
"""

from __future__ import annotations

import shutil
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citewise.schemas import AUTOMOBILE_ROOT, AUTOMOBILE_ROW, SPEEDING_ARRAY
from citewise.sources.records import locate, open_path

# Spark names text files *.txt; in a bundle each feed has its own extension.
EXTENSIONS = {"people": "csv", "speeding": "json", "automobiles": "xml", "notes": "txt"}


def write_people(people: DataFrame, path: str) -> str:
    people.write.mode("overwrite").csv(path, sep="|", header=True, escape='"')
    return path


def write_automobiles(automobiles: DataFrame, path: str) -> str:
    """One XML document per task."""
    vehicles = automobiles.select(F.to_xml(F.struct(*automobiles.columns), {"rowTag": AUTOMOBILE_ROW}).alias("value"))
    head = '<?xml version="1.0" encoding="UTF-8"?>\n'
    return _write_documents(vehicles, path, f"{head}<{AUTOMOBILE_ROOT}>", "", f"</{AUTOMOBILE_ROOT}>")


def write_speeding(speeding: DataFrame, path: str) -> str:
    """One JSON document per task."""
    tickets = speeding.select(F.to_json(F.struct(*speeding.columns)).alias("value"))
    return _write_documents(tickets, path, f'{{"{SPEEDING_ARRAY}":[', ",", "]}")


def _write_documents(records: DataFrame, path: str, lead: str, between: str, end: str) -> str:
    """A document per task, whole even where the task has no records: an opening line, the
    records, with ``between`` before all but the first, and a closing line."""

    def document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def line(text: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"value": pa.array([text], pa.string())})

        yield line(lead)
        first = len(between)
        for batch in batches:
            if batch.num_rows and first:
                yield line(batch.column("value")[0].as_py()[first:])
                batch, first = batch.slice(1), 0
            yield batch
        yield line(end)

    led = records.select(F.concat(F.lit(between), "value").alias("value"))
    led.mapInArrow(document, "value string").write.mode("overwrite").text(path)
    return path


def write_notes(notes: DataFrame, path: str) -> str:
    """Files that no feed takes: eight, by the remainder of the person's id."""
    notes.repartitionById(8, F.pmod("id", F.lit(8)).cast("int")).select("first_name").write.mode("overwrite").text(path)
    return path


def write_bundles(spark: SparkSession, folder: str) -> str:
    """Packs the feed files below ``folder`` into zip archives next to them.

    Archive n holds part n of each feed, so there are as many archives as parts and
    each is one small group of paths. Contents are streamed from file to file.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path")
        .withColumn("archive", F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1))
        .where(F.col("archive") != "")
    )

    def pack(paths: list[str], archive: str) -> str:
        base = paths[0].rsplit("/", 2)[0]
        system, target = locate(f"{base}/bundles/bundle-{archive}.zip")
        system.create_dir(target.rsplit("/", 1)[0])
        # Two attempts of a task never write the same file; the last one to end stays.
        own = f"{target}.{uuid.uuid4().hex}"
        with (
            system.open_output_stream(own) as out,
            zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as bundle,
        ):
            for path in sorted(paths):
                _, feed, file = path.rsplit("/", 2)
                name = f"feeds/{file.rsplit('.', 1)[0]}.{EXTENSIONS[feed]}"
                with open_path(path) as content, bundle.open(name, "w", force_zip64=True) as member:
                    shutil.copyfileobj(content, member, 1 << 20)
        system.move(own, target)
        return target

    def pack_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pydict({"written": pa.array([pack(row["paths"], row["archive"])], pa.string())})

    archives = files.groupBy("archive").agg(F.collect_list("path").alias("paths"))
    # Part numbers follow on one another. Without a number of tasks adaptive execution would
    # judge the archives by their names and pack all of them in one.
    tasks = spark.sparkContext.defaultParallelism
    dealt = archives.repartitionById(tasks, F.pmod(F.col("archive").cast("long"), F.lit(tasks)).cast("int"))
    dealt.mapInArrow(pack_all, "written string").write.mode("overwrite").parquet(f"{folder}-manifest")
    return f"{folder}/bundles"

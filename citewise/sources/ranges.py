"""Reading files of any size in many tasks, record by record.

Files are listed by path and cut into byte ranges. A file of one range is read and
checked by the task that cuts it. The ranges of a larger file are walked twice: a first
pass gives a small summary of each, and the summaries of a file, in order, tell the
state at the start of each range; then every range is cut on its own. The task in whose
range a record starts reads it to its end. What reaches the shuffle are names and
summaries, never the content.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import closing
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citewise.sources.records import open_path

# The most bytes of a file that one task holds at a time.
RANGE_BYTES = 32 * 1024 * 1024

RECORDS = "file string, name string, record string"

_RANGES = "file string, start long, stop long, size long"
_BATCH_CHARS = 4 * 1024 * 1024
_BATCH_RANGES = 1000
_AHEAD = 1 << 16
_BOM = b"\xef\xbb\xbf"


class _Range:
    """A range of an open file, moved behind separators at both ends."""

    def __init__(self, stream: BinaryIO, start: int, stop: int, size: int, separator: bytes) -> None:
        self.stream, self.ahead = stream, min(_AHEAD, max(stop - start, 1 << 10))
        begin = max(start - 1, 0)
        stream.seek(begin)
        data = stream.read(stop - begin)
        if start:
            found = data.find(separator)
            data = data[found + 1 :] if found >= 0 else None
        elif data.startswith(_BOM):
            data = data[len(_BOM) :]
        if data is None or (start and not data):
            # The first separator is the last byte, or lies beyond.
            data = b""
        elif stop < size and not data.endswith(separator):
            parts = [data]
            while more := self.more():
                found = more.find(separator)
                parts.append(more[: found + 1] if found >= 0 else more)
                if found >= 0:
                    stream.seek(found + 1 - len(more), 1)
                    break
            data = b"".join(parts)
        self.data = data

    def more(self) -> bytes:
        """What follows, twice as much each time."""
        self.ahead *= 2
        return self.stream.read(self.ahead // 2)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


class _OpenFile:
    """Keeps the last file open, since a task often has many ranges of it."""

    def __init__(self, open_file: Callable[[str], BinaryIO]) -> None:
        self.open_file, self.name, self.stream = open_file, None, None

    def __call__(self, name: str) -> BinaryIO:
        if name != self.name:
            self.close()
            self.stream, self.name = self.open_file(name), name
        return self.stream

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
        self.name = self.stream = None


def _summarizer(lexer, open_file):
    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        with closing(_OpenFile(open_file)) as opened:
            for row in _rows(batches):
                part = _Range(opened(row["file"]), row["start"], row["stop"], row["size"], lexer.SEPARATOR)
                summary = lexer.summary(part.data, row["start"] == 0)
                held.append({**row, "summary": json.dumps(summary)})
                if len(held) == _BATCH_RANGES:
                    yield pa.RecordBatch.from_pylist(held)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held)

    return summarize


def _composer(lexer):
    def compose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("start")
        state, states = lexer.START, []
        try:
            for summary in group["summary"]:
                states.append(json.dumps(state))
                state = lexer.after(state, json.loads(summary))
            lexer.finish(state)
        except ValueError as error:
            raise ValueError(f"{group['file'].iloc[0]}: {error}") from None
        return group.assign(state=states).drop(columns="summary")

    return compose


def _cutter(lexer, open_file):
    def batch(held: list[tuple[str, str, str]]) -> pa.RecordBatch:
        columns = [pa.array(values, pa.string()) for values in zip(*held)]
        return pa.RecordBatch.from_arrays(columns, ["file", "name", "record"])

    def records(row: dict, opened: _OpenFile) -> Iterator[tuple[str, str]]:
        if row["size"] < 0:
            if row["start"] != row["stop"]:
                raise ValueError("broken: a file without content")
            return
        part = _Range(opened(row["file"]), row["start"], row["stop"], row["size"], lexer.SEPARATOR)
        if row["state"] is None:
            state = lexer.START
            lexer.finish(lexer.after(state, json.loads(json.dumps(lexer.summary(part.data, True)))))
        else:
            state = json.loads(row["state"])
        yield from lexer.cut(part.data, state, part.more)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        with closing(_OpenFile(open_file)) as opened:
            for row in _rows(batches):
                file = row["file"]
                try:
                    for name, text in records(row, opened):
                        held.append((file, name, text))
                        chars += len(text)
                        if chars >= _BATCH_CHARS:
                            yield batch(held)
                            held, chars = [], 0
                except ValueError as error:
                    raise ValueError(f"{file}: {error}") from None
        if held:
            yield batch(held)

    return cut


def listed_bytes(files: DataFrame) -> int:
    """The size of the files behind a frame, from their listing; no job runs."""
    return int(str(files._jdf.queryExecution().analyzed().stats().sizeInBytes()))


def read_records(
    spark: SparkSession,
    path: str,
    lexer,
    pattern: str | None = None,
    range_bytes: int | None = None,
    open_file: Callable[[str], BinaryIO] = open_path,
) -> DataFrame:
    """(file, name, record): the records of all files of a folder, as text.

    ``range_bytes`` is how much one task holds at a time, by default
    ``spark.sql.files.maxPartitionBytes`` and at most 32 MB; the rows don't depend on it. A
    task takes as many small ranges, one after the other, as make up that default.
    """
    task_bytes = min(RANGE_BYTES, _bytes(spark, "spark.sql.files.maxPartitionBytes"))
    range_bytes = range_bytes or task_bytes
    task_bytes = max(task_bytes, range_bytes)
    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)
    size = listed_bytes(files)
    # Small input still goes to all cores, a megabyte at least to each.
    tasks = max(-(-size // task_bytes), min(spark.sparkContext.defaultParallelism, -(-size // (1 << 20))), 1)

    last = F.greatest(F.col("length") - 1, F.lit(0))
    starts = F.sequence(F.lit(0).cast("long"), last, F.lit(range_bytes).cast("long"))
    ranges = files.select(F.col("path").alias("file"), F.col("length").alias("size"), F.posexplode(starts).alias("n", "start"))
    ranges = ranges.withColumn("stop", F.least(F.col("start") + range_bytes, "size"))

    def spread(rows: DataFrame) -> DataFrame:
        """Neighbouring ranges go to different tasks."""
        place = F.pmod(F.xxhash64("file") + F.floor(F.col("start") / range_bytes), F.lit(tasks)).cast("int")
        return rows.repartitionById(tasks, place)

    columns = ["file", "start", "stop", "size"]
    whole = ranges.where(F.col("size") <= range_bytes).select(*columns, F.lit(None).cast("string").alias("state"))
    parts = spread(ranges.where(F.col("size") > range_bytes).select(columns))
    parts = parts.mapInArrow(_summarizer(lexer, open_file), f"{_RANGES}, summary string")
    parts = parts.groupBy("file").applyInPandas(_composer(lexer), f"{_RANGES}, state string")
    together = whole.unionByName(parts)
    if not _may_be_empty(lexer):
        together = together.unionByName(_listed(files, path))
    return of_unknown_size(spread(together).mapInArrow(_cutter(lexer, open_file), RECORDS))


def of_unknown_size(rows: DataFrame) -> DataFrame:
    """The same rows, of which Spark knows no size before it has shuffled them itself.

    Adaptive execution would judge records by the few bytes of the ranges they are cut
    from, and broadcast feeds of any size. A frame over an RDD counts as too large for
    that; this one has no rows and no tasks.
    """
    spark = rows.sparkSession
    return rows.union(spark.createDataFrame(spark.sparkContext.emptyRDD(), rows.schema))


def _may_be_empty(lexer) -> bool:
    try:
        lexer.finish(lexer.START)
    except ValueError:
        return False
    return True


def _listed(files: DataFrame, path: str) -> DataFrame:
    """One row that tells how many files have content (start) and how many are listed
    (stop): Spark lists files without content but reads none."""
    listed = F.lit(len(files._jdf.inputFiles())).cast("long")
    return files.agg(
        F.lit(path).alias("file"),
        F.count(F.lit(1)).alias("start"),
        listed.alias("stop"),
        F.lit(-1).cast("long").alias("size"),
        F.lit(None).cast("string").alias("state"),
    )


def _bytes(spark: SparkSession, setting: str) -> int:
    text = spark.conf.get(setting).lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    return int(text[:-1]) * units[text[-1]] if text[-1] in units else int(text)

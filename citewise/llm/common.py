"""What the operators share: tables in the shared folder, bounded batches of texts,
tables of distinct tokens, and splitting of texts by character class."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Texts are worked on so many characters at a time (a longer text alone), and so many
#: rows at most come to a Python worker at once.
CHUNK_CHARS = 1 << 20
BATCH_ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, else the context's
    checkpoint folder. Only a local session may go without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        set_there = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = set_there.get() if set_there.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="citewise-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def new_name(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, in any case of letters."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: its lineage ends there."""
    folder = new_folder(frame.sparkSession, name)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker is handed at once, unless the session says less."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def ranges(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Cuts a list of texts into runs of at most so many characters, or of one text."""
    low, held = 0, 0
    for i, text in enumerate(texts):
        if i > low and held + len(text) > most:
            yield low, i
            low, held = i, 0
        held += len(text)
    if low < len(texts):
        yield low, len(texts)


def map_texts(
    frame: DataFrame,
    keep: list[str],
    text: str,
    make: Callable[[], Callable[[list[str]], dict]],
    added: str,
    explode: bool = False,
) -> DataFrame:
    """Maps whole texts in chunks. make() gives, once a task, a function from a list of
    texts (NULL comes as None) to the columns named in `added`; with explode it also
    gives "row", the position of the text that an output row belongs to."""
    small_batches(frame.sparkSession)
    names = [f"_k{i}" for i in range(len(keep))]
    source = frame.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), F.col(text).alias("_text"))
    kept = [T.StructField(c, source.schema[n].dataType) for c, n in zip(keep, names)]
    schema = T.StructType(kept + T._parse_datatype_string(added).fields)
    arrow = to_arrow_schema(schema)
    fresh = [f.name for f in T._parse_datatype_string(added).fields]

    def run(batches):
        work = make()
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            for low, high in ranges([t or "" for t in texts]):
                out = work(texts[low:high])
                rows = batch.slice(low, high - low)
                if explode:
                    rows = rows.take(pa.array(out["row"], pa.int64()))
                columns = [rows.column(i).cast(arrow.field(i).type) for i in range(len(names))]
                columns += [pa.array(out[c], arrow.field(c).type) for c in fresh]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, schema)


class TokenTable:
    """Values of distinct tokens, computed once each; it starts anew when it holds more
    than `limit`. compute(tokens) gives a tuple of arrays, one entry for each token."""

    def __init__(self, compute, limit: int = 300_000):
        self.compute, self.limit = compute, limit
        self.index: dict[str, int] = {}
        self.values: tuple = ()

    def rows(self, tokens: list[str]) -> np.ndarray:
        """Positions in self.values, valid until the next call."""
        if len(self.index) > self.limit:
            self.index, self.values = {}, ()
        fresh = sorted(set(tokens).difference(self.index))
        if fresh:
            self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))
            new = self.compute(fresh)
            self.values = tuple(map(np.concatenate, zip(self.values, new))) if self.values else new
        return np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values, of the given lengths (0 gives 0)."""
    out = np.zeros((len(counts), *values.shape[1:]), values.dtype)
    full = counts > 0
    if full.any():
        out[full] = np.add.reduceat(values, (np.cumsum(counts) - counts)[full], axis=0)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads the bits of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))

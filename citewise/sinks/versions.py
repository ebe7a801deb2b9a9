"""Tables that change all at once.

A version's tables go into folders of their own; nobody reads those until one small file
that names them, the commit, is renamed into its place. A writer that dies before that
leaves readers the version before. Versions have a name (a run, a batch of a stream), and
a name that is committed is not written again, so a repeated run or batch adds nothing.
A commit replaces what was there, or adds to it.

The folder of a set of tables holds ``_versions`` with the commits, in their order, and
``data``. Only commits pass through the driver; Hadoop's file system handles them, so any
path that Spark reads will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_COMMITS, _DATA = "_versions", "data"


class _Files:
    """The file system of a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.jvm, self.folder = spark._jvm, folder.rstrip("/")
        self.system = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, folder: str) -> list[str]:
        if not self.system.exists(self.path(folder)):
            return []
        return sorted(status.getPath().getName() for status in self.system.listStatus(self.path(folder)))

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.system.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        return self.system.rename(self.path(old), self.path(new))

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def write_parquet(frame: DataFrame, folder: str) -> None:
    frame.write.parquet(folder)


class Publisher:
    """One version in the making: ``write`` its tables, then ``commit``."""

    def __init__(self, spark: SparkSession, path: str, version: str, replaces: bool = True) -> None:
        self.spark, self.path, self.version, self.replaces = spark, path.rstrip("/"), version, replaces
        self.files = _Files(spark, self.path)
        self.base = f"{self.path}/{_DATA}/{uuid.uuid4().hex}"
        self.tables: dict[str, str] = {}

    def done(self) -> bool:
        """Whether a version of this name is committed."""
        return any(commit["version"] == self.version for commit in _commits(self.files))

    def write(
        self, name: str, frame: DataFrame, write: Callable[[DataFrame, str], None] = write_parquet, folder: str | None = None
    ) -> str:
        """Writes one table; gives its folder, which nobody else reads yet."""
        folder = f"{self.base}/{folder or name}"
        write(frame, folder)
        self.tables[name] = folder.removeprefix(f"{self.path}/")
        return folder

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """A table that this version has written."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.path}/{self.tables[name]}")

    def commit(self) -> None:
        names = self.files.names(_COMMITS)
        number = int(names[-1].split("-")[0]) + 1 if names else 0
        told = {"version": self.version, "replaces": self.replaces, "tables": self.tables}
        draft = f"{_DATA}/{uuid.uuid4().hex}.json"
        self.files.write(draft, json.dumps(told))
        self.files.system.mkdirs(self.files.path(_COMMITS))
        name = f"{number:012d}-{quote(self.version, safe='')}.json"
        if not self.files.rename(draft, f"{_COMMITS}/{name}"):
            raise FileExistsError(f"another writer committed {name} to {self.path}")


def publish(spark: SparkSession, tables: dict[str, DataFrame], path: str, version: str, replaces: bool = True) -> bool:
    """Writes and commits a version; False if one of this name was there already."""
    publisher = Publisher(spark, path, version, replaces)
    if publisher.done():
        return False
    for name, frame in tables.items():
        publisher.write(name, frame)
    publisher.commit()
    return True


def published(spark: SparkSession, path: str, name: str, version: str | None = None) -> list[str]:
    """The folders of a table: of one version, or of the last that replaced the others and
    of all that were added since."""
    files = _Files(spark, path)
    commits = _commits(files)
    if version is not None:
        commits = [c for c in commits if c["version"] == version]
    for at in reversed(range(len(commits))):
        if commits[at]["replaces"]:
            commits = commits[at:]
            break
    return [f"{files.folder}/{c['tables'][name]}" for c in commits if name in c["tables"]]


def read_published(
    spark: SparkSession, path: str, name: str, schema: T.StructType | None = None, version: str | None = None
) -> DataFrame:
    """A table as the last commits have it; with a schema, no rows where there is none."""
    folders = published(spark, path, name, version)
    if not folders and schema is not None:
        return spark.createDataFrame([], schema)
    if not folders:
        raise FileNotFoundError(f"no version of {name} in {path}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*folders)


def forget_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes what all but the last ``keep`` replacing versions wrote. Commits stay, so
    their names stay taken."""
    files = _Files(spark, path)
    commits = _commits(files)
    replacing = [i for i, c in enumerate(commits) if c["replaces"]]
    if len(replacing) <= keep:
        return
    for commit in commits[: replacing[-keep]]:
        for folder in _bases(commit["tables"].values()):
            files.delete(folder)


def batch_version(spark: SparkSession, checkpoint: str, batch: int) -> str:
    """The name of a stream's batch: the same when the batch is repeated, another one for a
    stream that starts anew with a new checkpoint."""
    stream = json.loads(_Files(spark, checkpoint).read("metadata"))["id"]
    return f"{stream}-batch-{batch}"


def _bases(folders: Iterable[str]) -> set[str]:
    return {folder.rsplit("/", 1)[0] for folder in folders}


def _commits(files: _Files) -> list[dict]:
    return [json.loads(files.read(f"{_COMMITS}/{name}")) for name in files.names(_COMMITS) if name.endswith(".json")]

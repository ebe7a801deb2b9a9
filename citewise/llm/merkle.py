"""A Merkle manifest of a table: a tree for each group of rows, and one over their roots.

Every three consecutive nodes (the last run: fewer, even one) become the digest of their
digests, until one node is left. Trees are built by aligned append: rows in the order of
their tree are cut into blocks of 3^7, and a task appends a block's digests one by one to
its open subtrees. Each leaf of an open subtree carries a partial witness, and whenever
a run of siblings completes, the witnesses below it are extended by those siblings.
Block roots, from all tasks, are then appended likewise, in blocks of their own, until
every tree has one root; the witnesses of block roots go back down to extend the ones
inside their blocks. So a tree of any size, and one that holds a third of all rows,
is many tasks, and no task holds more than a block.

A row's place in its tree comes from one range-partitioned sort and the row counts of
its tasks. Lineage ends in tables below the shared folder, so a lost executor costs
the tasks it ran and no more.

A NULL group is a tree of its own, before the others; then groups go by their UTF-8
bytes. In a tree NULL ids come first; equal ids go by their leaf, so repeated rows, whose
leaves are equal, take neighbouring places. NULL values count as "-", an empty text is
not NULL. Texts of any length are hashed whole. Columns that are not named play no
part, whatever they are called; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stored

FAN = 3
HEIGHT = 7
BLOCK = FAN**HEIGHT

#: Rows that a task gives out at once.
_OUT_ROWS = 4 * BLOCK

_NODES = "tree string, at long, digest string, size long"


def row_digest(*values: Column) -> Column:
    """sha256 of the values: "-" for NULL, else the UTF-8 length, ":" and the value."""
    parts = [v.cast("string") for v in values]
    marked = [F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


def parent(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


class Append:
    """The open subtrees of a block that takes one digest after the other.

    `witnesses` holds a list of steps for each leaf: the position among the siblings,
    followed by their digests from left to right.
    """

    def __init__(self):
        self.open: list[list[tuple[str, int]]] = [[]]  # for each level (digest, its first leaf)
        self.witnesses: list[list[str]] = []

    def add(self, digest: str) -> None:
        self.witnesses.append([])
        self._push(0, digest, len(self.witnesses) - 1)

    def _push(self, level: int, digest: str, first: int) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((digest, first))
        if len(self.open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _ in run]
        ends = [first for _, first in run[1:]] + [len(self.witnesses)]
        for place, ((_, first), end) in enumerate(zip(run, ends)):
            step = str(place) + "".join(digests[:place] + digests[place + 1 :])
            for witness in self.witnesses[first:end]:
                witness.append(step)
        self._push(level + 1, parent(digests), run[0][1])

    def root(self, levels: int) -> str:
        """Completes the runs that are still open, up to the given height."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        return self.open[levels][0][0]


def _levels(size: int) -> int:
    """The height of a block in a tree of that size: a lone block ends at the root."""
    return HEIGHT if size > BLOCK else height(size)


def _blocks(batches, columns):
    """The rows of each (tree, block), from batches that are sorted by it."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row)
    if held:
        yield key, held


def _mapped(rows: DataFrame, work, schema: T.StructType) -> DataFrame:
    """work() turns batches into lists of tuples; they go out many at a time."""
    arrow = to_arrow_schema(schema)

    def out(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    def run(batches):
        held: list[tuple] = []
        for made in work(batches):
            held += made
            if len(held) >= _OUT_ROWS:
                yield out(held)
                held = []
        if held:
            yield out(held)

    return rows.mapInArrow(run, schema)


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")


def _block_roots(nodes: DataFrame) -> DataFrame:
    """One node for each block of nodes (tree, at, digest, size of the tree)."""

    def roots(batches):
        for (tree, block), rows in _blocks(batches, ["tree", "block", "digest", "size"]):
            size = rows[0][3]
            append = Append()
            for row in rows:
                append.add(row[2])
            yield [(tree, block, append.root(_levels(size)), -(-size // BLOCK))]

    cut = nodes.select("tree", F.expr(f"at div {BLOCK}").alias("block"), "at", "digest", "size")
    return _mapped(_dealt(cut), roots, T._parse_datatype_string(_NODES))


def _witnessed(nodes: DataFrame, upper: DataFrame, kept: list[str]) -> DataFrame:
    """The nodes with their witness up to the last root: steps joined by commas.

    `upper` has the witness of each block's root (tree, at = the block, steps) and two
    digests on its way, subroot and root. Block and witness meet in one sorted stream.
    """
    rows = nodes.select("tree", F.expr(f"at div {BLOCK}").alias("block"), "at", "digest", "size", *kept)
    lead = upper.select(
        "tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), F.col("steps").alias("digest"), "subroot", "root"
    )
    together = _dealt(rows.unionByName(lead, allowMissingColumns=True))
    columns = ["tree", "block", "at", "subroot", "root", "size", "digest", *kept]
    out = together.select("tree", "at", "subroot", "root", F.col("digest").alias("steps"), "digest", *kept)

    def witnessed(batches):
        for (tree, _), ((_, _, _, subroot, root, _, above, *_), *rows) in _blocks(batches, columns):
            append = Append()
            for row in rows:
                append.add(row[6])
            append.root(_levels(rows[0][5]))
            above = [above] if above else []
            yield [
                (tree, row[2], subroot, root, ",".join(witness + above), *row[6:])
                for row, witness in zip(rows, append.witnesses)
            ]

    return _mapped(together, witnessed, out.schema)


def _placed(nodes: DataFrame, *order: str) -> DataFrame:
    """Adds `at`, a node's number in its tree by the given order, and the tree's `size`."""
    by = ["tree", *order]
    ordered = nodes.repartitionByRange(*by).sortWithinPartitions(*by)
    ordered = stored(
        ordered.select(
            "*",
            F.spark_partition_id().alias("_task"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_row"),
        ),
        "merkle-order",
    )
    counts = ordered.groupBy("tree", "_task").agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
    tasks = Window.partitionBy("tree").orderBy("_task")
    counts = counts.select(
        "tree",
        "_task",
        (F.sum("_rows").over(tasks) - F.col("_rows") - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy("tree")).alias("size"),
    )
    placed = ordered.join(counts, ["tree", "_task"])
    return placed.select(*nodes.columns, (F.col("_row") + F.col("_shift")).alias("at"), "size")


def _rounds(nodes: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """(the nodes of each round, the last roots that each round ends with)."""
    rounds, ends = [nodes], []
    while True:
        roots = stored(_block_roots(rounds[-1]), "merkle-roots")
        ends.append(roots.where("size = 1"))
        more = roots.where("size > 1")
        if more.isEmpty():
            return rounds, ends
        rounds.append(more)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def witnesses(rows: DataFrame, group: str, id: str, digest: str, kept: list[str] = ()) -> DataFrame:
    """For each row id, digest, steps, subroot, root and the columns named in `kept`.

    `digest` names the column with the row's own digest; the witness `steps` leads from
    it over the root of its group's tree (subroot) to the root of all.
    """
    kept = list(kept)
    aliases = [f"_kept{i}" for i in range(len(kept))]
    # NULL before all others; what follows the sign keeps the order of bytes.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = rows.select(
        tree.alias("tree"),
        F.col(id).alias("_id"),
        F.col(digest).alias("digest"),
        *(F.col(c).alias(a) for c, a in zip(kept, aliases)),
    )
    leaves = stored(_placed(stored(leaves, "merkle-leaves"), "_id", "digest"), "merkle-placed")
    rounds, ends = _rounds(leaves)
    subroots = stored(_union(ends).select("tree", "digest"), "merkle-subroots")

    # The tree over the subroots, whose groups are its leaves.
    top = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    top_rounds, top_ends = _rounds(stored(_placed(top, "group"), "merkle-top"))
    root = top_ends[-1]
    upper = root.select("tree", "at", F.lit("").alias("steps"), "digest", F.col("digest").alias("root"))
    upper = upper.withColumnRenamed("digest", "subroot")
    for nodes in reversed(top_rounds[1:]):
        upper = stored(_witnessed(nodes, upper, []).drop("digest"), "merkle-witnesses")
    over = _witnessed(top_rounds[0], upper, ["group"])
    over = stored(over.select(F.col("group").alias("tree"), "steps", F.col("digest").alias("subroot"), "root"), "merkle-witnesses")

    # Down again: a tree's last root takes its group's witness, a block's root its own.
    lower = None
    for nodes, end in zip(reversed(rounds), reversed(ends)):
        upper = end.select("tree", "at").join(over, "tree").select("tree", "at", "steps", "subroot", "root")
        if lower is not None:
            upper = upper.unionByName(lower.select(upper.columns))
        if nodes is rounds[0]:
            break
        lower = stored(_witnessed(nodes, upper, []), "merkle-witnesses")
    found = _witnessed(rounds[0], upper, ["_id", *aliases])
    return found.select(
        F.col("_id").alias(id), F.col("digest").alias(digest), "steps", "subroot", "root", *(F.col(a).alias(c) for a, c in zip(aliases, kept))
    )


def siblings(steps: Column) -> Column:
    """The digests of a witness, from the leaf up and left to right, without separators."""
    return F.regexp_replace(steps, "(^|,).", "")


def folded(digest: Column, steps: Column) -> Column:
    """The root that a digest and a witness lead to."""

    def up(below: Column, step: Column) -> Column:
        before = F.substring(step, 1, 1).cast("int") * 64
        run = F.concat(step.substr(F.lit(2), before), below, step.substr(before + 2, F.length(step)))
        return F.sha2(run.cast("binary"), 256)

    return F.when(steps == "", digest).otherwise(F.aggregate(F.split(steps, ","), digest, up))

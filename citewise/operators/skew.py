"""Joins that keep a hot key off a single task.

Adaptive execution splits some skewed joins, but not one whose side is an aggregate,
and it measures compressed bytes, in which many rows with one key weigh little. The
joins here are told the hot keys and about how many rows each has. A caller finds them
with ``hot_weights``, one narrow pass over the key columns with a frequent-items sketch
per task; what reaches the driver is at most 1,000 keys per column. Without it the joins
are plain, and no job runs while a query is built. Hot keys only choose the way a row
takes, and every row takes one of the ways, so a key that is missed or has cooled down
changes nothing in the result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds more than one row in a thousand, so at most a thousand
# keys are, and more rows than one task handles with ease.
HOT_SHARE = 0.001
HOT_ROWS = 1_000_000

# How many rows of a hot key one task is given.
ROWS_PER_TASK = 1_000_000

# The share of rows the sketch takes in. It is the costly part of the pass.
SKETCHED = 0.01

# Enough that the sketch sees every key with a share of HOT_SHARE.
_TRACKED = 50_000


def hot_keys(*sides: tuple[DataFrame, str]) -> list[list]:
    """For each (rows, key): the keys with over ``HOT_SHARE`` of the rows and ``HOT_ROWS`` rows."""
    return [list(weights) for weights in hot_weights(*sides)]


def hot_weights(*sides: tuple[DataFrame, str]) -> list[dict]:
    """The same keys, each with its number of rows.

    The numbers are estimates from a sample; all rows are joined all the same. One Spark
    job does all sides.
    """
    found = [
        _frequent(rows, key).select(F.col("item").alias(f"side_{n}"), F.col("rows").alias(f"rows_{n}"))
        for n, (rows, key) in enumerate(sides)
    ]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found).collect()
    return [
        {row[f"side_{n}"]: int(row[f"rows_{n}"]) for row in together if row[f"side_{n}"] is not None}
        for n in range(len(sides))
    ]


def _frequent(rows: DataFrame, key: str) -> DataFrame:
    keyed = rows.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), (F.rand(7) < SKETCHED).alias("_sketched")
    )
    counted = keyed.agg(
        F.expr(
            f"approx_top_k(_key, {int(1 / HOT_SHARE)}, {_TRACKED}) FILTER (WHERE _sketched)"
        ).alias("_frequent"),
        F.count("*").alias("_rows"),
    )
    least = F.greatest(F.col("_rows") * HOT_SHARE, F.lit(float(HOT_ROWS)))
    estimated = counted.select(least.alias("_least"), F.inline("_frequent"))
    return estimated.select("_least", "item", (F.col("count") / SKETCHED).alias("rows")).where("rows > _least")


def join_with_unique(
    rows: DataFrame, key: str, table: DataFrame, table_key: str, hot: list
) -> DataFrame:
    """Inner join of ``rows``, with any skew, to a table that has one row per key.

    Rows with a hot key stay where they are and meet their table row, one of at most
    1,000, by broadcast. The others are shuffled.
    """
    match = F.col(key) == F.col(table_key)
    if not hot:
        return rows.join(table, match)
    few = F.broadcast(table.where(F.col(table_key).isin(hot)))
    cold = rows.where(~F.col(key).isin(hot)).join(table, match)
    return cold.unionByName(rows.where(F.col(key).isin(hot)).join(few, match))


def join_spread(
    left: DataFrame,
    left_key: str,
    right: DataFrame,
    right_key: str,
    left_hot: Mapping | Sequence,
    right_hot: Mapping | Sequence,
    parts: int | None = None,
) -> DataFrame:
    """Inner join in which neither side need be unique and both may be skewed.

    The pairs of a hot key form a grid: its rows on the left are dealt to so many parts as
    their number asks for (``ROWS_PER_TASK`` each), and so are those on the right; every
    part of one side meets every part of the other, so a row is repeated as often as the
    other side has parts. A key that is hot on one side is dealt there and repeated on the
    other. Other keys have one part. It is one join for all keys, so each side is read
    once. Rows are dealt by a hash of their values, so a repeated task deals as before;
    rows that differ in nothing stay together, so give it columns that differ.

    Where only the keys are known, and not their rows, they get ``parts`` (by default as
    many as a shuffle has), or the square of an edge if both sides are hot.
    """
    match = F.col(left_key) == F.col(right_key)
    grid = _grid(left_hot, right_hot, parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not grid:
        return left.join(right, match)
    spark, key_type = left.sparkSession, left.schema[left_key].dataType
    schema = T.StructType([T.StructField("_hot", key_type)]).add("_left_parts", T.IntegerType()).add("_right_parts", T.IntegerType())
    table = spark.createDataFrame([(key, *sizes) for key, sizes in grid.items()], schema)

    def dealt(rows: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Adds the row's part on its own side, and repeats it for those of the other."""
        placed = rows.join(F.broadcast(table), F.col(key) == F.col("_hot"), "left")
        own_parts, other_parts = (F.coalesce(f"_{side}_parts", F.lit(1)) for side in (own, other))
        return placed.select(
            *rows.columns,
            F.pmod(F.xxhash64(*rows.columns), own_parts).cast("int").alias(f"_{own}_of_{own}"),
            F.explode(F.sequence(F.lit(0), other_parts - 1)).alias(f"_{other}_of_{own}"),
        )

    together = dealt(left, left_key, "left", "right").join(
        dealt(right, right_key, "right", "left"),
        match
        & (F.col("_left_of_left") == F.col("_left_of_right"))
        & (F.col("_right_of_left") == F.col("_right_of_right")),
    )
    return together.select(*left.columns, *right.columns)


def _grid(left_hot: Mapping | Sequence, right_hot: Mapping | Sequence, parts: int) -> dict:
    """For each hot key the numbers of its parts on the left and on the right."""
    edge = math.isqrt(parts - 1) + 1
    grid = {}
    for key in {*left_hot, *right_hot}:
        sizes = []
        for side, other in ((left_hot, right_hot), (right_hot, left_hot)):
            if key not in side:
                sizes.append(1)
            elif isinstance(side, Mapping):
                sizes.append(max(1, math.ceil(side[key] / ROWS_PER_TASK)))
            else:
                sizes.append(edge if key in other else parts)
        if sizes != [1, 1]:
            grid[key] = tuple(sizes)
    return grid

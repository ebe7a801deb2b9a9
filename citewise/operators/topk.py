"""Highest rows of a table, with and without ties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(rows: DataFrame, measure: str, k: int, *tie_breakers: str) -> DataFrame:
    """The ``k`` highest rows; equal measures go by the tie-breakers, ascending.

    Sort plus limit runs as one per-task top-k and a merge of k rows per task.
    """
    return rows.orderBy(F.desc(measure), *[F.asc(name) for name in tie_breakers]).limit(k)


def top_k_with_ties(rows: DataFrame, measure: str, k: int) -> DataFrame:
    """Every row whose rank by ``measure`` is at most ``k``.

    Rank is at most k exactly when the measure reaches the k-th highest one. That
    value is a scalar subquery, so no task ever holds all rows as an
    unpartitioned ``rank()`` would. Rows with a NULL measure have no rank.
    """
    measured = rows.where(F.col(measure).isNotNull())
    kth = measured.select(measure).orderBy(F.desc(measure)).limit(k).agg(F.min(measure)).scalar()
    return measured.where(F.col(measure) >= kth)

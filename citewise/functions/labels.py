"""Text for the report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_label(key: Column) -> Column:
    """``December 2020`` for ``202012``; a key that is no month stays as it is."""
    month = F.try_to_timestamp(key, F.lit("yyyyMM"))
    return F.coalesce(F.date_format(month, "MMMM yyyy"), key, F.lit("unknown month"))


def full_name(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def joined_names(name: Column) -> Column:
    """Aggregate: all names of a group in one text, sorted, so that it is repeatable."""
    return F.array_join(F.sort_array(F.collect_list(name)), ",")


def tickets_line(label: Column, tickets: Column) -> Column:
    return F.format_string("%s: %d Tickets Written", label, tickets)


def amount_line(name: Column, amount: Column) -> Column:
    return F.format_string("%s: $%d", name, amount)

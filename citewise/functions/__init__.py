from citewise.functions.fees import (
    AS_CODED,
    PUBLISHED,
    FeeSchedule,
    fee_table,
    ticket_cost,
    with_fee_from_table,
)
from citewise.functions.labels import amount_line, full_name, joined_names, month_label, tickets_line
from citewise.functions.periods import as_time, month_key, month_of, year_of

__all__ = [
    "AS_CODED",
    "PUBLISHED",
    "FeeSchedule",
    "amount_line",
    "as_time",
    "fee_table",
    "full_name",
    "joined_names",
    "month_key",
    "month_label",
    "month_of",
    "ticket_cost",
    "tickets_line",
    "with_fee_from_table",
    "year_of",
]

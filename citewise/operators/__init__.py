from citewise.operators.counts import (
    max_count,
    month_counts,
    month_keys_in,
    months_and_officers,
    months_in,
    officers_in,
    report_counts,
    tickets_per_month_key,
    tickets_per_officer,
    with_max,
    year_counts,
    years_from_months,
)
from citewise.operators.ownership import Hot, estimate_hot, owner_totals, ticket_vehicle_owner
from citewise.operators.skew import hot_keys, hot_weights, join_spread, join_with_unique
from citewise.operators.topk import top_k, top_k_with_ties
from citewise.operators.trends import (
    change_since_previous,
    month_grid,
    month_rank_in_year,
    seasonal_index,
)

__all__ = [
    "Hot",
    "change_since_previous",
    "estimate_hot",
    "hot_keys",
    "hot_weights",
    "join_spread",
    "join_with_unique",
    "max_count",
    "month_counts",
    "month_grid",
    "month_keys_in",
    "month_rank_in_year",
    "months_and_officers",
    "months_in",
    "officers_in",
    "owner_totals",
    "report_counts",
    "seasonal_index",
    "ticket_vehicle_owner",
    "tickets_per_month_key",
    "tickets_per_officer",
    "top_k",
    "top_k_with_ties",
    "with_max",
    "year_counts",
    "years_from_months",
]

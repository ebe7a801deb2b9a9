from citewise.plans.questions import (
    officers_of,
    top_months,
    top_officers,
    top_officers_strict,
    top_payers,
    trend_tables,
)
from citewise.plans.report import report_lines
from citewise.plans.run import run_bundles, run_report

__all__ = [
    "officers_of",
    "report_lines",
    "run_bundles",
    "run_report",
    "top_months",
    "top_officers",
    "top_officers_strict",
    "top_payers",
    "trend_tables",
]

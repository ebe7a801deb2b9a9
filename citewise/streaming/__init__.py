from citewise.streaming.arrivals import RejectedMemberError, stage_arrivals
from citewise.streaming.months import month_counts_stream, read_latest, write_latest

__all__ = ["RejectedMemberError", "month_counts_stream", "read_latest", "stage_arrivals", "write_latest"]

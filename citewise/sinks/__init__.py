from citewise.sinks.tables import read_staged, stage_feeds, write_report, write_trends
from citewise.sinks.versions import Publisher, forget_versions, publish, published, read_published

__all__ = [
    "Publisher",
    "forget_versions",
    "publish",
    "published",
    "read_published",
    "read_staged",
    "stage_feeds",
    "write_report",
    "write_trends",
]

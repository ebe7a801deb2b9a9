from citewise.sources.automobiles import automobiles_from_records, read_automobiles
from citewise.sources.bundle import (
    bundle_members,
    bundle_records,
    list_archives,
    member_records,
    rejected,
    rejected_members,
    stream_archives,
)
from citewise.sources.census import (
    UnexpectedNameError,
    census_of_bundles,
    census_of_directories,
    census_of_members,
    require_expected,
)
from citewise.sources.load import (
    EmptyFeedError,
    Feeds,
    emptiness,
    feeds_from_archives,
    feeds_from_members,
    load_bundles,
    load_directories,
    require_rows,
)
from citewise.sources.paths import empty_feed
from citewise.sources.people import people_from_records, read_people
from citewise.sources.speeding import read_speeding, speeding_from_records

__all__ = [
    "EmptyFeedError",
    "Feeds",
    "UnexpectedNameError",
    "automobiles_from_records",
    "bundle_members",
    "bundle_records",
    "census_of_bundles",
    "census_of_directories",
    "census_of_members",
    "emptiness",
    "empty_feed",
    "feeds_from_archives",
    "feeds_from_members",
    "list_archives",
    "load_bundles",
    "load_directories",
    "member_records",
    "people_from_records",
    "read_automobiles",
    "read_people",
    "read_speeding",
    "rejected",
    "rejected_members",
    "require_expected",
    "require_rows",
    "speeding_from_records",
    "stream_archives",
]

"""Column layouts of the three feeds.

Key columns take the type the caller names ("bigint" or "string"), so that text
ids such as UUIDs are not turned into NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Names the feeds use.
PEOPLE_COLUMNS = ("id", "first_name", "last_name", "profession")
SPEEDING_COLUMNS = (
    "id",
    "officer_id",
    "ticket_time",
    "school_zone_ind",
    "work_zone_ind",
    "license_plate",
)
AUTOMOBILE_COLUMNS = ("person_id", "license_plate", "vin", "color", "year")
SPEEDING_ARRAY = "speeding_tickets"
AUTOMOBILE_ROOT = "automobiles"
AUTOMOBILE_ROW = "automobile"
OFFICER_PROFESSION = "Police Officer"

# The one column every automobile record needs: the link to its owner.
OWNER_COLUMN = "person_id"


def strings(columns: Sequence[str]) -> T.StructType:
    """A schema that holds every named column as text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def ddl(schema: T.StructType) -> str:
    """The schema as text, for functions that take no other form."""
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def people_schema(key_type: str = "bigint") -> T.StructType:
    return T.StructType.fromDDL(
        f"id {key_type}, first_name string, last_name string, profession string"
    )


def speeding_schema(key_type: str = "bigint") -> T.StructType:
    return T.StructType.fromDDL(
        f"id string, officer_id {key_type}, ticket_time string, "
        "school_zone_ind boolean, work_zone_ind boolean, license_plate string"
    )


def automobiles_schema(columns: Sequence[str] | None = None) -> T.StructType:
    """Text columns, as the XML gives them; ``columns`` replaces the usual five."""
    columns = tuple(columns or AUTOMOBILE_COLUMNS)
    if OWNER_COLUMN not in columns:
        raise ValueError(f"automobile columns must hold {OWNER_COLUMN}: {columns}")
    return strings(columns)

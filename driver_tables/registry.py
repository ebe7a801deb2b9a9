"""Every query, by name, and its SQL where it has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citewise import functions as fn
from citewise import operators as op
from citewise import plans, sinks, sources, streaming
from citewise.workspace import shared_folder
from driver_tables import feed_files
from driver_tables.tables import (
    OFFICERS,
    OWNERSHIP,
    TICKET_ID,
    TICKET_OFFICER,
    TICKET_TIME,
    automobiles,
    feeds,
    is_officer,
    people,
    school,
    speeding,
    table,
    work,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _lineitem(spark, folder):
    return table(spark, folder, "lineitem")


def _months(spark, folder):
    return op.month_counts(_lineitem(spark, folder), TICKET_TIME, TICKET_ID)


def _years(spark, folder):
    return op.year_counts(_lineitem(spark, folder), TICKET_TIME, TICKET_ID)


# ---- officers


@query
def officer_filter(spark, folder):
    officers = plans.officers_of(table(spark, folder, "supplier"), is_officer())
    return officers.select("s_suppkey", "s_name")


@query
def tickets_per_officer(spark, folder):
    return op.tickets_per_officer(_lineitem(spark, folder), TICKET_OFFICER, TICKET_ID)


@query
def max_ticket_count(spark, folder):
    return op.max_count(tickets_per_officer(spark, folder))


@query
def top_officer(spark, folder):
    return plans.top_officers(
        table(spark, folder, "supplier"), _lineitem(spark, folder), is_officer(), **OFFICERS
    )


@query
def top_officer_strict(spark, folder):
    return plans.top_officers_strict(
        table(spark, folder, "supplier"), _lineitem(spark, folder), is_officer(), **OFFICERS
    )


# ---- months and years


@query
def month_key(spark, folder):
    key = fn.month_key(F.col(TICKET_TIME)).alias("yyyymm")
    return _lineitem(spark, folder).select("l_orderkey", "l_linenumber", key)


@query
def tickets_per_month_key(spark, folder):
    return op.tickets_per_month_key(_lineitem(spark, folder), TICKET_TIME, TICKET_ID)


@query
def top_months(spark, folder):
    return plans.top_months(_lineitem(spark, folder), 3, TICKET_TIME, TICKET_ID)


@query
def top_month_labels(spark, folder):
    label = fn.month_label(F.col("yyyymm")).alias("label")
    return top_months(spark, folder).select(label, "ticket_count")


@query
def top_months_with_ties(spark, folder):
    return op.top_k_with_ties(tickets_per_month_key(spark, folder), "ticket_count", 3)


@query
def month_counts(spark, folder):
    return plans.trend_tables(_lineitem(spark, folder), TICKET_TIME, TICKET_ID).months


@query
def year_counts(spark, folder):
    return plans.trend_tables(_lineitem(spark, folder), TICKET_TIME, TICKET_ID).years


@query
def years_from_months(spark, folder):
    return op.years_from_months(_months(spark, folder))


@query
def officer_and_month_counts(spark, folder):
    return op.months_and_officers(
        _lineitem(spark, folder), TICKET_OFFICER, TICKET_TIME, TICKET_ID
    )


# ---- trends


@query
def yoy_change(spark, folder):
    return op.change_since_previous(_years(spark, folder), "year")


@query
def mom_change(spark, folder):
    return op.change_since_previous(_months(spark, folder), "month")


@query
def seasonal_index(spark, folder):
    index = op.seasonal_index(_months(spark, folder))
    return index.withColumn("seasonal_index", F.round("seasonal_index", 9))


@query
def month_rank_in_year(spark, folder):
    ranks = op.month_rank_in_year(_months(spark, folder))
    return ranks.select(
        F.col("year").cast("bigint").alias("year"),
        "month",
        "ticket_count",
        F.col("month_rank").cast("bigint").alias("month_rank"),
    )


@query
def month_grid(spark, folder):
    return op.month_grid(_months(spark, folder))


# ---- fees and payers


def _priced(spark, folder, schedule):
    cost = fn.ticket_cost(school(), work(), schedule).alias("ticket_cost")
    return _lineitem(spark, folder).select("l_orderkey", "l_linenumber", cost)


def _hot(spark, folder):
    tables = table(spark, folder, "orders"), _lineitem(spark, folder), table(spark, folder, "customer")
    return op.estimate_hot(*tables, **OWNERSHIP)


def _totals(spark, folder, schedule):
    return op.owner_totals(
        table(spark, folder, "orders"),
        _lineitem(spark, folder),
        table(spark, folder, "customer"),
        fn.ticket_cost(school(), work(), schedule),
        hot=_hot(spark, folder),
        **OWNERSHIP,
    )


def _payers(spark, folder, schedule):
    return plans.top_payers(
        table(spark, folder, "customer"),
        _lineitem(spark, folder),
        table(spark, folder, "orders"),
        schedule,
        school=school(),
        work=work(),
        names=("c_name",),
        hot=_hot(spark, folder),
        **OWNERSHIP,
    )


@query
def ticket_cost_published(spark, folder):
    return _priced(spark, folder, fn.PUBLISHED)


@query
def ticket_cost_as_coded(spark, folder):
    return _priced(spark, folder, fn.AS_CODED)


@query
def ticket_cost_lookup(spark, folder):
    priced = fn.with_fee_from_table(
        _lineitem(spark, folder), fn.fee_table(spark, fn.PUBLISHED), school(), work()
    )
    return priced.select("l_orderkey", "l_linenumber", "ticket_cost")


@query
def ticket_vehicle_owner(spark, folder):
    return op.ticket_vehicle_owner(
        table(spark, folder, "orders"),
        _lineitem(spark, folder),
        table(spark, folder, "customer"),
        fn.ticket_cost(school(), work(), fn.AS_CODED),
        hot=_hot(spark, folder),
        **OWNERSHIP,
    )


@query
def owner_totals_published(spark, folder):
    return _totals(spark, folder, fn.PUBLISHED)


@query
def owner_totals_as_coded(spark, folder):
    return _totals(spark, folder, fn.AS_CODED)


@query
def top_payers_published(spark, folder):
    return _payers(spark, folder, fn.PUBLISHED)


@query
def top_payers_as_coded(spark, folder):
    return _payers(spark, folder, fn.AS_CODED)


@query
def top_payers_with_ties(spark, folder):
    return op.top_k_with_ties(
        _totals(spark, folder, fn.PUBLISHED), "total_ticketed_amount", 10
    )


# ---- sources: each writes a table in a feed's format and reads it back

# Cuts the files of the smallest tables, too.
SMALL_RANGE = 1 << 14
# How the written documents are called: Spark names text files so.
WRITTEN = "*.txt"


def _written(spark, name):
    return shared_folder(spark, name)


@query
def src_csv_pipe(spark, folder):
    path = feed_files.write_people(people(spark, folder), _written(spark, "people"))
    return sources.read_people(spark, path)


@query
def src_csv_pipe_inferred(spark, folder):
    path = feed_files.write_people(people(spark, folder), _written(spark, "people"))
    inferred = sources.read_people(spark, path, infer=True)
    return inferred.withColumn("id", F.col("id").cast("bigint"))


@query
def src_json_envelope(spark, folder):
    path = feed_files.write_speeding(speeding(spark, folder), _written(spark, "speeding"))
    return sources.read_speeding(spark, path, files=WRITTEN)


@query
def src_json_envelope_in_pieces(spark, folder):
    """The same documents, each in many ranges."""
    path = feed_files.write_speeding(speeding(spark, folder), _written(spark, "speeding"))
    return sources.read_speeding(spark, path, files=WRITTEN, range_bytes=SMALL_RANGE)


@query
def src_xml_rows(spark, folder):
    path = feed_files.write_automobiles(automobiles(spark, folder), _written(spark, "automobiles"))
    return sources.read_automobiles(spark, path, files=WRITTEN)


@query
def src_xml_rows_in_pieces(spark, folder):
    path = feed_files.write_automobiles(automobiles(spark, folder), _written(spark, "automobiles"))
    return sources.read_automobiles(spark, path, range_bytes=SMALL_RANGE, files=WRITTEN)


@query
def src_xml_chosen_columns(spark, folder):
    chosen = ("person_id", "license_plate")
    path = feed_files.write_automobiles(
        automobiles(spark, folder).select(*chosen), _written(spark, "automobiles")
    )
    return sources.read_automobiles(spark, path, columns=chosen, files=WRITTEN)


@query
def src_xml_two_columns(spark, folder):
    """Two columns of the documents, and none of the others."""
    path = feed_files.write_automobiles(automobiles(spark, folder), _written(spark, "automobiles"))
    return sources.read_automobiles(spark, path, files=WRITTEN).select("vin", "year")


@query
def src_xml_count(spark, folder):
    """How many vehicles there are, with no column read."""
    path = feed_files.write_automobiles(automobiles(spark, folder), _written(spark, "automobiles"))
    return sources.read_automobiles(spark, path, files=WRITTEN).groupBy().agg(F.count(F.lit(1)).alias("vehicles"))


@query
def src_csv_quoted_newlines(spark, folder):
    """Names with line breaks, quotes and separators, in many ranges."""
    odd = F.concat(F.col("first_name"), F.lit('\n"'), F.col("last_name"), F.lit('"|\r\n'), F.col("profession"))
    path = feed_files.write_people(people(spark, folder).withColumn("first_name", odd), _written(spark, "people"))
    return sources.read_people(spark, path, range_bytes=SMALL_RANGE)


@query
def top_payers_from_folders(spark, folder):
    """The question put to the files themselves, past the gate."""
    base, tables = _written(spark, "feeds"), feeds(spark, folder)
    for name, frame in tables._asdict().items():
        getattr(feed_files, f"write_{name}")(frame, f"{base}/{name}")
    loaded = sources.load_directories(
        spark, f"{base}/people", f"{base}/speeding", f"{base}/automobiles", speeding_files=WRITTEN, automobile_files=WRITTEN
    )
    top = plans.top_payers(*sources.require_rows(loaded), fn.AS_CODED)
    return top.select("person_id", "first_name", "total_ticketed_amount")


def _in_many_files(frame):
    """At least one file per core, so that a feed is many files at any size."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores)


@query
def src_dir_union(spark, folder):
    """Many files in one folder come back as one frame."""
    path = feed_files.write_people(
        _in_many_files(people(spark, folder)), _written(spark, "people")
    )
    return sources.read_people(spark, path)


def _bundles(spark, folder, *names):
    base = _written(spark, "feeds")
    all_feeds = feeds(spark, folder)
    for name in names:
        frame = getattr(all_feeds, name)
        getattr(feed_files, f"write_{name}")(_in_many_files(frame), f"{base}/{name}")
    return feed_files.write_bundles(spark, base)


@query
def src_zip_bundle(spark, folder):
    bundles = _bundles(spark, folder, "people", "speeding", "automobiles")
    return sources.load_bundles(spark, bundles).speeding


@query
def src_zip_bundle_people(spark, folder):
    return sources.load_bundles(spark, _bundles(spark, folder, "people")).people


@query
def src_zip_bundle_people_wide(spark, folder):
    """People files with a column more, at the front."""
    base = _written(spark, "feeds")
    nation = F.col("c_nationkey").cast("string").alias("nation")
    wide = table(spark, folder, "customer").select(nation, F.col("c_custkey").alias("_key"))
    wide = people(spark, folder).join(wide, F.col("id") == F.col("_key")).drop("_key")
    wide = wide.select("nation", *[c for c in wide.columns if c != "nation"])
    feed_files.write_people(_in_many_files(wide), f"{base}/people")
    bundles = feed_files.write_bundles(spark, base)
    return sources.load_bundles(spark, bundles, more_people=["nation"]).people


@query
def src_json_inferred(spark, folder):
    """Types as Spark finds them in the documents."""
    path = feed_files.write_speeding(speeding(spark, folder), _written(spark, "speeding"))
    return sources.read_speeding(spark, path, infer=True, files=WRITTEN)


@query
def src_dir_missing(spark, folder):
    """A folder that is missing adds no rows to one that is there."""
    path = feed_files.write_people(people(spark, folder), _written(spark, "people"))
    missing = sources.read_people(spark, _written(spark, "missing"))
    return sources.read_people(spark, path).unionByName(missing)


@query
def src_zip_bundle_automobiles(spark, folder):
    return sources.load_bundles(spark, _bundles(spark, folder, "automobiles")).automobiles


def _with_notes(spark, folder):
    """Bundles of people files and of files that no feed takes."""
    base = _written(spark, "feeds")
    feed_files.write_people(_in_many_files(people(spark, folder)), f"{base}/people")
    feed_files.write_notes(people(spark, folder), f"{base}/notes")
    return feed_files.write_bundles(spark, base)


def _refused(members):
    part = F.regexp_extract("member", r"part-(\d+)", 1).alias("part")
    return members.select(part, "extension", "member_bytes")


@query
def src_zip_rejected(spark, folder):
    """The members that no feed takes."""
    return _refused(sources.rejected_members(sources.list_archives(spark, _with_notes(spark, folder))))


@query
def src_name_census(spark, folder):
    """Tags, keys and header names of all three feeds, counted."""
    base, tables = _written(spark, "feeds"), feeds(spark, folder)
    for name, frame in tables._asdict().items():
        getattr(feed_files, f"write_{name}")(frame, f"{base}/{name}")
    census = sources.census_of_directories(
        spark, f"{base}/people", f"{base}/speeding", f"{base}/automobiles", speeding_files=WRITTEN, automobile_files=WRITTEN
    )
    return census.select("feed", "name", "expected", "records")


@query
def empty_gate(spark, folder):
    return sources.emptiness(
        {name: table(spark, folder, name) for name in ("customer", "lineitem", "orders")}
    )


# ---- report and sinks


@query
def report_lines(spark, folder):
    tables = feeds(spark, folder)
    hot = op.estimate_hot(tables.automobiles, tables.speeding, tables.people)
    return plans.report_lines(tables, hot=hot)


@query
def report_text(spark, folder):
    """The text a run leaves behind, from bundles to report file."""
    bundles = _bundles(spark, folder, "people", "speeding", "automobiles")
    loaded = sources.load_bundles(spark, bundles)
    report = plans.run_report(spark, loaded, _written(spark, "out"), "check")
    return spark.read.text(report).withColumnRenamed("value", "line")


@query
def report_text_of_bundles(spark, folder):
    """A whole run on bundles, which lists their members once."""
    bundles = _bundles(spark, folder, "people", "speeding", "automobiles")
    report = plans.run_bundles(spark, bundles, _written(spark, "out"), "check")
    return spark.read.text(report).withColumnRenamed("value", "line")


@query
def trend_sink(spark, folder):
    """The month table as the chart would read it."""
    path = _written(spark, "trends")
    sinks.write_trends(_months(spark, folder), _years(spark, folder), path)
    return sinks.read_published(spark, path, "months")


@query
def trend_sink_years(spark, folder):
    """The year table as the chart would read it."""
    path = _written(spark, "trends")
    sinks.write_trends(_months(spark, folder), _years(spark, folder), path)
    return sinks.read_published(spark, path, "years")


# ---- streams


@query
def stream_bundle(spark, folder):
    bundles = _bundles(spark, folder, "people", "speeding", "automobiles")
    out = _written(spark, "arrivals")
    started = streaming.stage_arrivals(
        spark, bundles, f"{out}/staged", f"{out}/checkpoints", archives_per_batch=4
    )
    for arrival in started:
        arrival.awaitTermination()
    return sinks.read_staged(spark, f"{out}/staged").speeding.drop("ticket_year")


def _arrived(spark, folder, name):
    bundles = _bundles(spark, folder, name)
    out = _written(spark, "arrivals")
    started = streaming.stage_arrivals(spark, bundles, f"{out}/staged", f"{out}/checkpoints")
    for arrival in started:
        arrival.awaitTermination()
    return getattr(sinks.read_staged(spark, f"{out}/staged"), name)


@query
def stream_bundle_people(spark, folder):
    return _arrived(spark, folder, "people")


@query
def stream_bundle_automobiles(spark, folder):
    return _arrived(spark, folder, "automobiles")


@query
def stream_month_counts_closed(spark, folder):
    """The months that can change no more: all but the newest one."""
    schema = _lineitem(spark, folder).schema
    tickets = spark.readStream.schema(schema).parquet(f"{folder}/lineitem*.parquet")
    out = _written(spark, "closed")
    counts = streaming.month_counts_stream(tickets, TICKET_TIME, TICKET_ID, lateness="1 day")
    started = (
        counts.writeStream.format("parquet")
        .option("path", f"{out}/counts")
        .option("checkpointLocation", f"{out}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{out}/counts")


@query
def stream_rejected(spark, folder):
    """The members that no feed takes, as bundles arrive."""
    out = _written(spark, "arrivals")
    for arrival in streaming.stage_arrivals(
        spark, _with_notes(spark, folder), f"{out}/staged", f"{out}/checkpoints", archives_per_batch=4
    ):
        arrival.awaitTermination()
    return _refused(sinks.read_published(spark, f"{out}/staged", "rejected"))


@query
def stream_month_counts(spark, folder):
    schema = _lineitem(spark, folder).schema
    # A pattern, since a stream takes a folder or a pattern but not one file's name.
    tickets = spark.readStream.schema(schema).parquet(f"{folder}/lineitem*.parquet")
    out = _written(spark, "months")
    streaming.write_latest(
        streaming.month_counts_stream(tickets, TICKET_TIME, TICKET_ID),
        f"{out}/counts",
        f"{out}/checkpoint",
    ).awaitTermination()
    return streaming.read_latest(spark, f"{out}/counts")


# ---- SQL

_FEE = """CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 120
     WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN {zone} ELSE 30 END"""
_PUBLISHED, _AS_CODED = _FEE.format(zone=60), _FEE.format(zone=90)

_COUNTS = "SELECT l_suppkey, count(l_linenumber) AS ticket_count FROM lineitem GROUP BY 1"
_KEY = "regexp_replace(substring(CAST(l_shipdate AS VARCHAR), 1, 7), '-', '')"
_KEYED = f"SELECT {_KEY} AS yyyymm, count(l_linenumber) AS ticket_count FROM lineitem GROUP BY 1"
_MONTHS = """SELECT date_trunc('month', l_shipdate) AS month,
    count(l_linenumber) AS ticket_count FROM lineitem GROUP BY 1"""
_YEARS = """SELECT date_trunc('year', l_shipdate) AS year,
    count(l_linenumber) AS ticket_count FROM lineitem GROUP BY 1"""
_PEOPLE = """SELECT c_custkey AS id, c_name AS first_name, c_mktsegment AS last_name,
    CASE WHEN c_acctbal > 0 THEN 'Police Officer' ELSE 'Citizen' END AS profession FROM customer"""
_SPEEDING = """SELECT l_orderkey || '-' || l_linenumber AS id, l_suppkey AS officer_id,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ticket_time,
    l_returnflag = 'R' AS school_zone_ind, l_linestatus = 'O' AS work_zone_ind,
    CAST(l_orderkey AS VARCHAR) AS license_plate FROM lineitem"""
_AUTOMOBILES = """SELECT CAST(o_custkey AS VARCHAR) AS person_id,
    CAST(o_orderkey AS VARCHAR) AS license_plate, 'VIN' || o_orderkey AS vin,
    o_orderpriority AS color, CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders"""


def _priced_sql(fee: str) -> str:
    return f"SELECT l_orderkey, l_linenumber, CAST({fee} AS BIGINT) AS ticket_cost FROM lineitem"


def _totals_sql(fee: str) -> str:
    return f"""SELECT o_custkey AS person_id, CAST(sum({fee}) AS BIGINT) AS total_ticketed_amount
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey GROUP BY 1"""


def _payers_sql(fee: str) -> str:
    return f"""SELECT t.person_id, c_name, total_ticketed_amount
        FROM ({_totals_sql(fee)}) t JOIN customer ON c_custkey = t.person_id
        ORDER BY total_ticketed_amount DESC, person_id LIMIT 10"""


_REPORT = f"""
WITH people AS ({_PEOPLE}),
speeding AS ({_SPEEDING}),
automobiles AS ({_AUTOMOBILES}),
officers AS (SELECT officer_id, count(id) AS n FROM speeding GROUP BY 1),
top AS (SELECT first_name || ' ' || last_name AS name, n FROM officers
    JOIN people ON people.id = officer_id
    WHERE profession = 'Police Officer' AND n = (SELECT max(n) FROM officers)),
months AS (SELECT date_trunc('month', CAST(ticket_time AS TIMESTAMP)) AS month,
    count(id) AS n FROM speeding GROUP BY 1),
years AS (SELECT date_trunc('year', month) AS year, CAST(sum(n) AS BIGINT) AS n
    FROM months GROUP BY 1),
ranked_months AS (SELECT month, n, row_number() OVER (ORDER BY n DESC, month) AS i FROM months),
totals AS (SELECT people.id AS person_id,
    sum(CASE WHEN school_zone_ind AND work_zone_ind THEN 120
        WHEN school_zone_ind OR work_zone_ind THEN 90 ELSE 30 END) AS total
    FROM automobiles a JOIN speeding s ON a.license_plate = s.license_plate
    JOIN people ON people.id = CAST(a.person_id AS BIGINT) GROUP BY 1),
payers AS (SELECT first_name || ' ' || last_name AS name, total,
    row_number() OVER (ORDER BY total DESC, person_id) AS i
    FROM totals JOIN people ON people.id = person_id),
changes AS (SELECT 1 AS part, year(year) AS line_no, strftime(year, '%Y') AS label, n,
        n - lag(n) OVER (ORDER BY year) AS change FROM years
    UNION ALL SELECT 2, 1000000 + year(month) * 100 + month(month), strftime(month, '%Y-%m'), n,
        n - lag(n) OVER (ORDER BY month) FROM months)
SELECT question, CAST(line_no AS INTEGER) AS line_no, line FROM (
    SELECT '1' AS question, 1 AS line_no, 'Officer(s) ' ||
        coalesce((SELECT string_agg(name, ',' ORDER BY name) FROM top), '') ||
        ' distributed the most speeding tickets: ' ||
        coalesce((SELECT max(n) FROM top), 0) AS line
    UNION ALL SELECT '2', 0, 'These are the top three months by total tickets written'
    UNION ALL SELECT '2', i, strftime(month, '%B %Y') || ': ' || n || ' Tickets Written'
        FROM ranked_months WHERE i <= 3
    UNION ALL SELECT '3', 0,
        'These are the top ten most ticketed drivers by total ticket dollars levied'
    UNION ALL SELECT '3', i, name || ': $' || total FROM payers WHERE i <= 10
    UNION ALL SELECT '4', 0,
        'Tickets written per year and month, with the change since the one before'
    UNION ALL SELECT '4', line_no, label || ': ' || n || ' Tickets Written' ||
        CASE WHEN change IS NULL THEN ''
             WHEN change < 0 THEN ' (' || change || ')'
             ELSE ' (+' || change || ')' END FROM changes)
"""

_REFUSED = """SELECT lpad(CAST(c_custkey % 8 AS VARCHAR), 5, '0') AS part, 'txt' AS extension,
    CAST(sum(strlen(c_name) + 1) AS BIGINT) AS member_bytes FROM customer GROUP BY c_custkey % 8"""


def _names_sql(feed: str, lead: str, names: str, table: str) -> str:
    """One row for each name; all records have it."""
    return f"""SELECT '{feed}' AS feed, '{lead}' || name AS name, true AS expected, (SELECT count(*) FROM {table}) AS records
        FROM (SELECT unnest(string_split('{names}', ' ')) AS name)"""


_CENSUS = " UNION ALL ".join(
    (
        _names_sql("people", "people/", "id first_name last_name profession", "customer"),
        _names_sql(
            "speeding",
            "speeding_tickets/",
            "id officer_id ticket_time school_zone_ind work_zone_ind license_plate",
            "lineitem",
        ),
        _names_sql("automobiles", "automobiles/", "automobile", "orders"),
        _names_sql("automobiles", "automobiles/automobile/", "person_id license_plate vin color year", "orders"),
    )
)

SQL = {
    "officer_filter": "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0",
    "tickets_per_officer": _COUNTS,
    "max_ticket_count": f"SELECT max(ticket_count) AS max_ticket_count FROM ({_COUNTS})",
    "top_officer": f"""WITH c AS ({_COUNTS})
        SELECT l_suppkey AS officer_id, s_name, ticket_count FROM c
        JOIN supplier ON s_suppkey = l_suppkey
        WHERE s_acctbal > 0 AND ticket_count = (SELECT max(ticket_count) FROM c)""",
    "top_officer_strict": f"""WITH c AS (SELECT l_suppkey AS officer_id, s_name, ticket_count
            FROM ({_COUNTS}) JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal > 0)
        SELECT * FROM c WHERE ticket_count = (SELECT max(ticket_count) FROM c)""",
    "month_key": f"SELECT l_orderkey, l_linenumber, {_KEY} AS yyyymm FROM lineitem",
    "tickets_per_month_key": _KEYED,
    "top_months": f"{_KEYED} ORDER BY ticket_count DESC, yyyymm LIMIT 3",
    "top_month_labels": f"""SELECT strftime(month, '%B %Y') AS label, ticket_count
        FROM ({_MONTHS} ORDER BY ticket_count DESC, month LIMIT 3)""",
    "top_months_with_ties": f"""SELECT yyyymm, ticket_count FROM (SELECT *,
        rank() OVER (ORDER BY ticket_count DESC) AS r FROM ({_KEYED})) WHERE r <= 3""",
    "month_counts": _MONTHS,
    "year_counts": _YEARS,
    "years_from_months": _YEARS,
    "officer_and_month_counts": """SELECT
            CASE WHEN grouping(l_suppkey) = 0 THEN 'officer' ELSE 'month' END AS kind,
            l_suppkey AS officer_id, month, count(l_linenumber) AS ticket_count
        FROM (SELECT l_suppkey, l_linenumber, date_trunc('month', l_shipdate) AS month
            FROM lineitem) GROUP BY GROUPING SETS ((l_suppkey), (month))""",
    "yoy_change": f"""SELECT year, ticket_count,
        ticket_count - lag(ticket_count) OVER (ORDER BY year) AS change FROM ({_YEARS})""",
    "mom_change": f"""SELECT month, ticket_count,
        ticket_count - lag(ticket_count) OVER (ORDER BY month) AS change FROM ({_MONTHS})""",
    "seasonal_index": f"""WITH m AS ({_MONTHS})
        SELECT CAST(month(month) AS INTEGER) AS month_number,
            round(avg(ticket_count) / (SELECT avg(ticket_count) FROM m), 9) AS seasonal_index
        FROM m GROUP BY 1""",
    "month_rank_in_year": f"""SELECT year(month) AS year, month, ticket_count,
        rank() OVER (PARTITION BY year(month) ORDER BY ticket_count DESC) AS month_rank
        FROM ({_MONTHS})""",
    "month_grid": f"""WITH m AS ({_MONTHS})
        SELECT g.month, coalesce(ticket_count, 0) AS ticket_count
        FROM (SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month
            FROM m) g LEFT JOIN m ON m.month = g.month""",
    "ticket_cost_published": _priced_sql(_PUBLISHED),
    "ticket_cost_as_coded": _priced_sql(_AS_CODED),
    "ticket_cost_lookup": """SELECT l_orderkey, l_linenumber, CAST(fee AS BIGINT) AS ticket_cost
        FROM lineitem JOIN (VALUES (false, false, 30), (true, false, 60), (false, true, 60),
            (true, true, 120)) f(school, work, fee)
        ON (l_returnflag = 'R') = school AND (l_linestatus = 'O') = work""",
    "ticket_vehicle_owner": f"""SELECT o_custkey AS person_id, CAST({_AS_CODED} AS BIGINT)
        AS ticket_cost FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey""",
    "owner_totals_published": _totals_sql(_PUBLISHED),
    "owner_totals_as_coded": _totals_sql(_AS_CODED),
    "top_payers_published": _payers_sql(_PUBLISHED),
    "top_payers_as_coded": _payers_sql(_AS_CODED),
    "top_payers_with_ties": f"""SELECT person_id, total_ticketed_amount FROM (SELECT *,
        rank() OVER (ORDER BY total_ticketed_amount DESC) AS r FROM ({_totals_sql(_PUBLISHED)}))
        WHERE r <= 10""",
    "src_csv_pipe": _PEOPLE,
    "src_csv_pipe_inferred": _PEOPLE,
    "src_json_envelope": _SPEEDING,
    "src_json_envelope_in_pieces": _SPEEDING,
    "src_xml_rows": _AUTOMOBILES,
    "src_xml_rows_in_pieces": _AUTOMOBILES,
    "src_xml_chosen_columns": f"SELECT person_id, license_plate FROM ({_AUTOMOBILES})",
    "src_xml_two_columns": f"SELECT vin, year FROM ({_AUTOMOBILES})",
    "src_xml_count": "SELECT count(*) AS vehicles FROM orders",
    "src_csv_quoted_newlines": f"""SELECT id, first_name || chr(10) || '"' || last_name || '"|' || chr(13) || chr(10) ||
        profession AS first_name, last_name, profession FROM ({_PEOPLE})""",
    "top_payers_from_folders": f"""SELECT person_id, c_name AS first_name, total_ticketed_amount
        FROM ({_payers_sql(_AS_CODED)})""",
    "src_zip_rejected": _REFUSED,
    "stream_rejected": _REFUSED,
    "src_name_census": _CENSUS,
    "report_text_of_bundles": f"SELECT line FROM ({_REPORT})",
    "src_dir_union": _PEOPLE,
    "src_zip_bundle": _SPEEDING,
    "src_zip_bundle_people": _PEOPLE,
    "src_zip_bundle_automobiles": _AUTOMOBILES,
    "empty_gate": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) = 0 AS is_empty FROM {name}"
        for name in ("customer", "lineitem", "orders")
    ),
    "report_lines": _REPORT,
    "report_text": f"SELECT line FROM ({_REPORT})",
    "trend_sink": _MONTHS,
    "stream_bundle": _SPEEDING,
    "stream_bundle_people": _PEOPLE,
    "stream_bundle_automobiles": _AUTOMOBILES,
    "stream_month_counts": _MONTHS,
    "stream_month_counts_closed": f"""WITH m AS ({_MONTHS})
        SELECT * FROM m WHERE month < (SELECT max(month) FROM m)""",
    "trend_sink_years": _YEARS,
    "src_json_inferred": _SPEEDING,
    "src_dir_missing": _PEOPLE,
    "src_zip_bundle_people_wide": _PEOPLE.replace(
        " FROM customer", ", CAST(c_nationkey AS VARCHAR) AS nation FROM customer"
    ),
}

"""How the star-schema tables stand in for tickets, vehicles and people.

A ticket is a lineitem: supplier = officer, order key = plate, ship date = time. A
vehicle is an order, owned by its customer. People are customers, officers suppliers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citewise.sources.load import Feeds

# Column names that the operators are given for these tables.
TICKET_TIME = "l_shipdate"
TICKET_ID = "l_linenumber"
TICKET_OFFICER = "l_suppkey"
TICKET_PLATE = "l_orderkey"
OWNERSHIP = {
    "ticket_plate": TICKET_PLATE,
    "plate": "o_orderkey",
    "owner": "o_custkey",
    "person": "c_custkey",
}
OFFICERS = {
    "names": ("s_name",),
    "officer": TICKET_OFFICER,
    "ticket": TICKET_ID,
    "person": "s_suppkey",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Months and years are compared as instants: both sides use UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def school():
    return F.col("l_returnflag") == "R"


def work():
    return F.col("l_linestatus") == "O"


def is_officer():
    return F.col("s_acctbal") > 0


def people(spark: SparkSession, folder: str) -> DataFrame:
    officer = F.when(F.col("c_acctbal") > 0, "Police Officer").otherwise("Citizen")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        officer.alias("profession"),
    )


def speeding(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_suppkey").alias("officer_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("ticket_time"),
        school().alias("school_zone_ind"),
        work().alias("work_zone_ind"),
        F.col("l_orderkey").cast("string").alias("license_plate"),
    )


def automobiles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("person_id"),
        F.col("o_orderkey").cast("string").alias("license_plate"),
        F.concat(F.lit("VIN"), F.col("o_orderkey").cast("string")).alias("vin"),
        F.col("o_orderpriority").alias("color"),
        F.year("o_orderdate").cast("string").alias("year"),
    )


def feeds(spark: SparkSession, folder: str) -> Feeds:
    return Feeds(people(spark, folder), speeding(spark, folder), automobiles(spark, folder))

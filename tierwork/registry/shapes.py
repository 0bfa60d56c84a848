"""Incident-shaped and version-tagged rows made from whole test tables.

The test tables hold no nulls and no copies, so the incident rows get both from values found in
the data: a price, balance or date in a certain range leaves a field empty, and an order is filed
again for each of its returned lines at the highest discount. Every order is in, once at least.

``INCIDENT_SQL`` and ``SNAPSHOT_SQL`` say the same for DuckDB; the Spark side reads no SQL.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = (
    "Number",
    "Opened",
    "short_description",
    "Caller",
    "User_ID",
    "Priority",
    "State",
    "Category",
    "Assignment_Group",
    "Assigned_To",
    "Channel",
    "Service",
    "Service_Family",
    "Service_Subcategory",
    "Updated",
    "Updated_By",
)

DATE_PATTERN = "dd-MM-yyyy HH:mm"

COMMITS = (
    (0, datetime(2024, 1, 1), "CREATE TABLE"),
    (1, datetime(2024, 1, 5), "WRITE"),
    (2, datetime(2024, 1, 9), "MERGE"),
    (3, datetime(2024, 1, 12), "WRITE"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident rows in the sixteen columns of the incident dataset, dates as timestamps."""
    lineitem = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    orders = table(spark, sf_dir, "orders")
    lines = lineitem.groupBy("o_orderkey").agg(
        F.max("l_shipdate").alias("shipped"),
        F.count("*").alias("lines"),
        F.min("l_suppkey").alias("first_supplier"),
        F.max("l_suppkey").alias("last_supplier"),
        F.max("l_linenumber").alias("last_line"),
        F.max("l_quantity").alias("units"),
    )
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    people = (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumnRenamed("c_custkey", "o_custkey")
    )
    price, balance, units = F.col("o_totalprice"), F.col("c_acctbal"), F.col("units")
    family = F.when(units >= 40, "Bulk").when(units >= 15, "Mixed").otherwise("Single")
    again = lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.1))
    filings = orders.select("o_orderkey").unionByName(again.select("o_orderkey"))
    return (
        orders.join(people, "o_custkey")
        .join(lines, "o_orderkey", "left")
        .join(filings, "o_orderkey")
        .select(
            _unless(price < 7000, F.concat(F.lit("INC"), F.col("o_orderkey"))).alias("Number"),
            _unless(balance > 9850, F.col("o_orderdate")).alias("Opened"),
            F.concat(F.lit("Order of "), F.col("lines"), F.lit(" lines")).alias("short_description"),
            _unless(balance.between(9000, 9300), F.col("c_name")).alias("Caller"),
            _unless(balance.between(9200, 9500), F.concat(F.lit("U"), "o_custkey")).alias("User_ID"),
            F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("Priority"),
            _unless((F.col("o_orderstatus") == "P") & (price > 480000), F.col("o_orderstatus")).alias(
                "State"
            ),
            _unless(balance < -900, F.col("c_mktsegment")).alias("Category"),
            _unless(balance < 0, F.col("n_name")).alias("Assignment_Group"),
            F.concat(F.lit("S"), "first_supplier").alias("Assigned_To"),
            _unless(F.col("o_orderdate") < _day("1996-01-01"), F.col("r_name")).alias("Channel"),
            F.concat(F.lit("Line "), "last_line").alias("Service"),
            _unless(units.isNull() | (units < 10), family).alias("Service_Family"),
            F.concat(family, F.lit(" "), F.col("o_orderstatus"), F.lit(" "), "r_name").alias(
                "Service_Subcategory"
            ),
            F.col("shipped").alias("Updated"),
            F.concat(F.lit("S"), "last_supplier").alias("Updated_By"),
        )
    )


INCIDENT_SQL = """
lines AS (
  SELECT l_orderkey, max(l_shipdate) AS shipped, count(*) AS lines, min(l_suppkey) AS first_supplier,
    max(l_suppkey) AS last_supplier, max(l_linenumber) AS last_line, max(l_quantity) AS units,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_discount >= 0.1) AS again
  FROM lineitem GROUP BY l_orderkey),
once AS (
  SELECT
    CASE WHEN o_totalprice < 7000 THEN NULL ELSE 'INC' || o_orderkey END AS Number,
    CASE WHEN c_acctbal > 9850 THEN NULL ELSE o_orderdate END AS Opened,
    'Order of ' || lines || ' lines' AS short_description,
    CASE WHEN c_acctbal BETWEEN 9000 AND 9300 THEN NULL ELSE c_name END AS Caller,
    CASE WHEN c_acctbal BETWEEN 9200 AND 9500 THEN NULL ELSE 'U' || o_custkey END AS User_ID,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS Priority,
    CASE WHEN o_orderstatus = 'P' AND o_totalprice > 480000 THEN NULL ELSE o_orderstatus END AS State,
    CASE WHEN c_acctbal < -900 THEN NULL ELSE c_mktsegment END AS Category,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE n_name END AS Assignment_Group,
    'S' || first_supplier AS Assigned_To,
    CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN NULL ELSE r_name END AS Channel,
    'Line ' || last_line AS Service,
    CASE WHEN units >= 40 THEN 'Bulk' WHEN units >= 15 THEN 'Mixed' WHEN units >= 10 THEN 'Single' END
      AS Service_Family,
    CASE WHEN units >= 40 THEN 'Bulk ' WHEN units >= 15 THEN 'Mixed ' ELSE 'Single ' END
      || o_orderstatus || ' ' || r_name AS Service_Subcategory,
    shipped AS Updated,
    'S' || last_supplier AS Updated_By,
    unnest(range(coalesce(again, 0) + 1)) AS copy_number
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey LEFT JOIN lines ON l_orderkey = o_orderkey),
inc AS (SELECT * EXCLUDE (copy_number) FROM once)"""


def with_text_dates(rows: DataFrame) -> DataFrame:
    """Dates as the text an incident export holds."""
    return rows.withColumns(
        {name: F.date_format(name, DATE_PATTERN) for name in ("Opened", "Updated")}
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four versions of the orders, read once: a first load of the years before 2001, the rest
    appended, a merge that closes old open orders and removes cheap ones, and a repeated append
    of the last open month that leaves exact copies."""
    date, status, price = F.col("o_orderdate"), F.col("o_orderstatus"), F.col("o_totalprice")
    merged = F.when((date < _day("1996-01-01")) & (status == "O"), "F").otherwise(status)
    remains = price >= 20000
    repeated = remains & (status == "P") & (date >= _day("2001-07-01"))

    def entry(version: int, state: Column) -> Column:
        return F.struct(
            F.lit(version).alias("_version"),
            F.to_timestamp_ntz(F.lit(str(COMMITS[version][1]))).alias("_commit_timestamp"),
            state.alias("status"),
        )

    entries = F.array_compact(
        F.array(
            F.when(date < _day("2001-01-01"), entry(0, status)),
            entry(1, status),
            F.when(remains, entry(2, merged)),
            F.when(remains, entry(3, merged)),
            F.when(repeated, entry(3, merged)),
        )
    )
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("k"), price.alias("price"), F.explode(entries).alias("e"))
        .select("e._version", "e._commit_timestamp", "k", "e.status", "price")
    )


SNAPSHOT_SQL = """
v0 AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS date
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
v1 AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS date FROM orders),
v2 AS (
  SELECT k, CASE WHEN date < TIMESTAMP '1996-01-01' AND status = 'O' THEN 'F' ELSE status END AS status,
    price, date FROM v1 WHERE price >= 20000),
v3 AS (
  SELECT * FROM v2 UNION ALL SELECT * FROM v2 WHERE status = 'P' AND date >= TIMESTAMP '2001-07-01'),
snap AS (
  SELECT 0 AS _version, TIMESTAMP '2024-01-01' AS _commit_timestamp, k, status, price FROM v0
  UNION ALL SELECT 1, TIMESTAMP '2024-01-05', k, status, price FROM v1
  UNION ALL SELECT 2, TIMESTAMP '2024-01-09', k, status, price FROM v2
  UNION ALL SELECT 3, TIMESTAMP '2024-01-12', k, status, price FROM v3)"""


def operations(spark: SparkSession) -> DataFrame:
    """The operation log that goes with the snapshots: one row per version."""
    rows = [(version, operation) for version, _, operation in COMMITS]
    return spark.createDataFrame(rows, "version int, operation string")


def commits(spark: SparkSession) -> DataFrame:
    """When each version was committed: one row per version."""
    rows = [(version, str(at)) for version, at, _ in COMMITS]
    listed = spark.createDataFrame(rows, "_version int, at string")
    return listed.select("_version", F.col("at").cast("timestamp").alias("_commit_timestamp"))

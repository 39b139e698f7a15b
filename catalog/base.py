"""Canonical contact, meeting, call and note frames built from the driver tables.

Column expressions that both engines understand are written once; the functions give the Spark
frames, the ``*_SQL`` texts the same rows for the SQL side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS_AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


CONTACT_COLUMNS = {
    "contact_id": "c_custkey",
    "LeadStageNewCEO": (
        "CASE WHEN c_acctbal < -900 THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Lead'"
        " WHEN c_mktsegment = 'BUILDING' THEN 'SQL 1' WHEN c_mktsegment = 'FURNITURE' THEN 'SAL 2'"
        " WHEN c_mktsegment = 'MACHINERY' THEN 'SAL 1' ELSE 'Client' END"
    ),
    "LeadStageNew": (
        "CASE WHEN c_acctbal > 8000 THEN 'Committed Capital' WHEN c_acctbal > 6000 THEN 'OFFER SENT'"
        " WHEN c_acctbal > 4000 THEN 'Booked Meeting' WHEN c_acctbal > 2000 THEN 'Dormant Lead'"
        " WHEN c_acctbal > 0 THEN 'Others' END"
    ),
    "OnboardingId": "CASE WHEN c_acctbal > 3000 THEN c_custkey END",
    "ClientType": "r_name",
    "ContactType": "r_name",
    "IsThisLeadAlreadyFoundInAnInternalDatabase": "CASE WHEN c_acctbal < 0 THEN 'Found' ELSE 'Not Found' END",
    "Country": "n_name",
    "City": "CASE WHEN c_acctbal < 9500 THEN lower(concat('al ', r_name, '-o''', n_name)) END",
    "Nationality": (
        "CASE WHEN r_name = 'AFRICA' THEN ' KSA ' WHEN r_name = 'ASIA' THEN 'Saudi'"
        " WHEN r_name = 'AMERICA' THEN 'saudi_arabian ' WHEN r_name = 'EUROPE' THEN 'Bahraini' ELSE r_name END"
    ),
    "Gender": "CASE WHEN c_nationkey < 8 THEN 'Yes' WHEN c_nationkey < 16 THEN 'No' WHEN c_nationkey < 20 THEN 'Institution' END",
    "AgeRange": (
        "CASE WHEN c_acctbal < 0 THEN 'Below 20' WHEN c_acctbal < 2000 THEN '21 - 30' WHEN c_acctbal < 4000 THEN '31 - 40'"
        " WHEN c_acctbal < 6000 THEN '41 - 50' WHEN c_acctbal < 8000 THEN '51 - 60' WHEN c_acctbal < 9000 THEN 'Above 60' END"
    ),
    "EngagementLabel": "CASE WHEN c_acctbal < 1000 THEN 'Low' WHEN c_acctbal < 5000 THEN 'Medium' WHEN c_acctbal < 9000 THEN 'High' END",
    "MaritalStatus": "nullif(c_mktsegment, 'BUILDING')",
    "CampaignType": "CASE WHEN c_acctbal > 5000 THEN 'Awareness' WHEN c_acctbal > 1000 THEN 'Lead Gen' END",
    "PreferredLanguage": "CASE WHEN r_name = 'ASIA' THEN 'Arabic' END",
    "UTMCampaignFirstTouch": (
        "CASE WHEN c_mktsegment = 'BUILDING' THEN ' AOS Retire 2024' WHEN c_mktsegment = 'MACHINERY' THEN 'ORGANIC search'"
        " WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_mktsegment END"
    ),
    "FirstPageSeen": (
        "CASE WHEN c_mktsegment = 'BUILDING' THEN concat('https://my.example.com/', n_name)"
        " WHEN c_mktsegment = 'MACHINERY' THEN 'https://www.example.com/start' WHEN c_acctbal > 7000 THEN 'https://linkedin.com/client'"
        " WHEN c_acctbal > 3000 THEN concat('https://other.org/', r_name) WHEN c_acctbal > 0 THEN 'https://facebook.com/x' END"
    ),
    "SegmentClass": "n_regionkey",
    "PageDirectoryArticles": "CASE WHEN c_acctbal > 2500 THEN c_nationkey END",
    "CreateDate": "first_order",
    "LastContactedDate": "last_order",
    "FollowUpDate": "CASE WHEN c_acctbal > 0 THEN first_order END",
}

CONTACTS_SQL = (
    "contacts AS (SELECT "
    + ", ".join(f'{expr} AS "{name}"' for name, expr in CONTACT_COLUMNS.items())
    + " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
    " LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order"
    " FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey)"
)


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )
    base = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    return base.selectExpr(*[f"{expr} AS `{name}`" for name, expr in CONTACT_COLUMNS.items()])


_OUTCOME = (
    "CASE WHEN o_totalprice < 50000 THEN NULL WHEN o_orderstatus = 'F' THEN 'COMPLETED'"
    " WHEN o_orderstatus = 'O' THEN 'SCHEDULED' WHEN o_orderstatus = 'P' THEN 'CANCELED' END"
)
_SEGMENT = "CAST(substr(o_orderpriority, 1, 1) AS INT) - 2"
MEETINGS_SQL = f"""
raw_meetings AS (
  SELECT o_orderkey AS event_id, o_custkey AS contact_id, o_orderdate AS activity_raw, o_orderpriority AS note,
         {_SEGMENT} AS seg, {_OUTCOME} AS outcome,
         o_orderdate - to_days(CAST(o_orderkey % 30 AS INTEGER)) - INTERVAL 10 HOUR AS created
  FROM orders),
meetings AS (
  SELECT *, CAST(CAST(CASE WHEN outcome = 'SCHEDULED' THEN created ELSE activity_raw END AS DATE) AS TIMESTAMP) AS activity
  FROM raw_meetings)"""


def meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = "o_orderdate - make_dt_interval(CAST(o_orderkey % 30 AS INT), 10, 0, 0)"
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS event_id",
        "o_custkey AS contact_id",
        f"{created} AS CreateDate",
        "o_orderdate AS ActivityDate",
        f"{_OUTCOME} AS MeetingOutcome",
        "o_orderpriority AS MeetingNotesPreview",
        f"{_SEGMENT} AS seg",
    )


_DISPOSITION = (
    "CASE WHEN event_type = 'purchase' THEN 'Connected' WHEN event_type = 'view' THEN 'No Answer'"
    " WHEN event_type = 'click' THEN 'Left Voicemail' WHEN event_type = 'error' THEN 'Busy' END"
)
CALLS_SQL = f"""
calls AS (
  SELECT event_id, user_id AS contact_id, {_DISPOSITION} AS outcome, props AS note, ts AS activity,
         ts - to_hours(CAST(event_id % 50 AS INTEGER)) AS created
  FROM events)"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id AS contact_id",
        "ts - make_dt_interval(0, CAST(event_id % 50 AS INT), 0, 0) AS CreateDate",
        "ts AS ActivityDate",
        f"{_DISPOSITION} AS callDisposition",
        "props AS CallNotesPreview",
    )


def days_sql(start: str, end: str) -> str:
    return f"CAST(floor((epoch_us({end}) - epoch_us({start})) / 86400000000.0) AS BIGINT)"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating-point columns to a fixed number of digits."""
    return df.withColumns({n: F.round(_q(n), digits) for n, t in df.dtypes if t in ("double", "float")})


def whole(df: DataFrame) -> DataFrame:
    """Integer columns as bigint."""
    return df.withColumns({n: F.col(_q(n)).cast("bigint") for n, t in df.dtypes if t in ("int", "smallint", "tinyint")})


def _q(name: str) -> str:
    return f"`{name}`"


def tidy(df: DataFrame) -> DataFrame:
    return whole(rounded(df))

"""Inputs of the sample queries, derived from the given tables.

The given tables hold no blank values, so some columns are made dirty by rules on ids.
The derivations are expressions both engines understand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "2024-01-15"
FIRST_DAY = "2024-01-01"
LAST_DAY = "2024-01-30"
RUN_TS = "2024-02-01 06:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that both engines return the same kind of value."""
    def show(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return column

    return df.select([show(field) for field in df.schema])


def _common_table(name: str, columns: tuple[str, ...], source: str) -> str:
    return f"{name} AS (SELECT {', '.join(columns)} FROM {source})"


_BALANCES = (
    "event_id",
    "user_id AS account_id",
    """CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_type = 'click' THEN 'VBA'
            WHEN event_type = 'view' THEN 'TA' WHEN event_type = 'error' THEN 'VBO'
            ELSE event_type END AS account_type""",
    """CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'NULL'
            WHEN event_id % 17 = 0 THEN 'null' WHEN event_id % 19 = 0 THEN ''
            WHEN event_id % 23 = 0 THEN '   ' WHEN event_id % 29 = 0 THEN 'Null'
            ELSE props END AS dirty""",
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS amount",
    "CAST(ts AS DATE) AS as_of_date",
)
BALANCES = _common_table("balances", _BALANCES, "events")


def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account balances: one snapshot per day of events."""
    return table(spark, sf_dir, "events").selectExpr(*_BALANCES)


_TRANSACTIONS = (
    "l_orderkey AS account_id",
    "l_partkey AS part_id",
    "l_suppkey AS supplier_id",
    """CASE WHEN l_suppkey % 31 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'TA'
            WHEN l_returnflag = 'N' THEN 'VBO' ELSE 'VBA' END AS account_type""",
    """CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN '  '
            WHEN l_orderkey % 17 = 0 THEN 'null' ELSE l_returnflag END AS flag""",
    "CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE l_extendedprice END AS amount",
    "CAST(date_trunc('month', l_shipdate) AS DATE) AS as_of_date",
)
TRANSACTIONS = _common_table("transactions", _TRANSACTIONS, "lineitem")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions: one snapshot per month of shipped line items."""
    return table(spark, sf_dir, "lineitem").selectExpr(*_TRANSACTIONS)


_STATUS_EVENTS = (
    "concat('domain_', CAST(user_id % 5 AS STRING)) AS domain",
    "concat('table_', CAST(user_id AS STRING)) AS table_name",
    """CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'view' THEN 'NO_CHANGE'
            WHEN 'error' THEN 'FAILURE' WHEN 'signup' THEN 'MAINTENANCE' END AS status""",
    "ts",
)
STATUS_EVENTS = _common_table("status_events", _STATUS_EVENTS, "events")


def status_events(events: DataFrame) -> DataFrame:
    """Status events of upstream tables: one table per user, five domains."""
    return events.selectExpr(*_STATUS_EVENTS).withColumnRenamed("table_name", "table")


SUMMARY = """
summary AS (
  SELECT domain, table_name, max(ts) AS last_updated, arg_max(status, ts) AS latest_status,
    max(ts) FILTER (WHERE status = 'SUCCESS') AS last_success,
    max(ts) FILTER (WHERE status = 'NO_CHANGE') AS last_no_change,
    max(ts) FILTER (WHERE status = 'FAILURE') AS last_failure,
    max(ts) FILTER (WHERE status = 'MAINTENANCE') AS last_maintenance
  FROM status_events WHERE status IS NOT NULL GROUP BY domain, table_name)"""

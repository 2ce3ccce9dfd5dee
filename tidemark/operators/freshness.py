"""Are the upstream tables of a domain up to date, and may a run start?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import (
    CUT_OFF, CUT_OFF_ZONE, as_date, before_cut_off, status_time, wall_clock,
)

# The labels of a status event, strongest first where two share a moment.
STATUS_FIELDS = {
    "SUCCESS": "lastSuccess",
    "NO_CHANGE": "lastNoChange",
    "FAILURE": "lastFailure",
    "MAINTENANCE": "lastMaintenance",
}
READY, WAIT, FAILED = "READY", "WAIT", "FAILED"


def classify_freshness(status: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Add ``is_fresh``: loaded, or confirmed unchanged, on the given date.

    The latest status and failures have no say. A table without a time is not fresh.
    """
    day = F.lit(as_date(as_of))

    def on_day(name: str) -> Column:
        return F.coalesce(F.to_date(status_time(F.col(name))) == day, F.lit(False))

    return status.withColumn("is_fresh", on_day("lastSuccess") | on_day("lastNoChange"))


def verdict(
    n_stale: Column, now_utc: Column, cut_off: str = CUT_OFF, zone: str = CUT_OFF_ZONE
) -> Column:
    """Before the cut-off WAIT for stale tables or go; from the cut-off on it is too late."""
    return (
        F.when(~before_cut_off(now_utc, cut_off, zone), FAILED)
        .when(n_stale > 0, WAIT)
        .otherwise(READY)
    )


def readiness(
    classified: DataFrame,
    now_utc: dt.datetime | str | Column,
    cut_off: str = CUT_OFF,
    zone: str = CUT_OFF_ZONE,
) -> DataFrame:
    """One row per domain: table counts and the verdict at a moment."""
    return (
        classified.groupBy("domain")
        .agg(
            F.count(F.lit(1)).alias("n_tables"),
            F.count_if(~F.col("is_fresh")).alias("n_stale"),
        )
        .withColumn("verdict", verdict(F.col("n_stale"), wall_clock(now_utc), cut_off, zone))
    )


def status_summary(events: DataFrame) -> DataFrame:
    """Latest time of each status per table, from (domain, table, status, ts) events.

    Gives the fields a status service would return. Only times are aggregated, which
    hash aggregation keeps in place; the latest status follows from them.
    """
    latest = [
        F.max(F.when(F.col("status") == label, F.col("ts"))).alias(name)
        for label, name in STATUS_FIELDS.items()
    ]
    status = F.coalesce(*[
        F.when(F.col(name) == F.col("lastUpdated"), F.lit(label))
        for label, name in STATUS_FIELDS.items()
    ])
    return (
        events.where(F.col("status").isin(*STATUS_FIELDS))
        .groupBy("domain", "table")
        .agg(F.max("ts").alias("lastUpdated"), *latest)
        .select("domain", "table", "lastUpdated", status.alias("latestStatus"),
                *STATUS_FIELDS.values())
    )

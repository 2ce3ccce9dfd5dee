"""The snapshot before a given one."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import as_date, day_in
from tidemark.operators.reconcile import TARGET

K = TypeVar("K")


def previous_snapshot(df: DataFrame, as_of: dt.date | str) -> DataFrame:
    """One row (as_of_date, yest_ingest_dt): the latest earlier date with rows, or NULL."""
    return (
        df.where(F.col("as_of_date") < day_in(df, as_of))
        .agg(F.max("as_of_date").cast("date").alias("yest_ingest_dt"))
        .select(F.lit(as_date(as_of)).alias("as_of_date"), "yest_ingest_dt")
    )


def previous_snapshot_dates(
    tables: Mapping[K, DataFrame], as_of: dt.date | str, window_days: int = 100
) -> dict[K, dt.date | None]:
    """The latest earlier date with rows of every table: one job for all of them.

    Only partitions of the last ``window_days`` are read; tables that hold nothing there
    share a second job over their older ones.
    """
    day = as_date(as_of)
    start = day - dt.timedelta(days=window_days)
    found = _latest(tables, start, day)
    older = {key: df for key, df in tables.items() if found[key] is None}
    return found | _latest(older, None, start)


def _latest(
    tables: Mapping[K, DataFrame], start: dt.date | None, end: dt.date
) -> dict[K, dt.date | None]:
    """Latest date from ``start`` up to but not including ``end``."""
    parts = []
    for n, df in enumerate(tables.values()):
        dates = df.where(F.col("as_of_date") < day_in(df, end))
        if start is not None:
            dates = dates.where(F.col("as_of_date") >= day_in(df, start))
        parts.append(dates.agg(F.max("as_of_date").cast("date").alias("day")).select(
            F.lit(n).alias("n"), "day"))
    rows = reduce(DataFrame.unionByName, parts).collect() if parts else []
    days = {row["n"]: row["day"] for row in rows}
    return {key: days[n] for n, key in enumerate(tables)}


def previous_snapshots(df: DataFrame, table_columns: Sequence[str] = TARGET) -> DataFrame:
    """For every snapshot of every table its predecessor, NULL for the first.

    Rows are reduced to one per table and date before the window is applied.
    """
    order = Window.partitionBy(*table_columns).orderBy("as_of_date")
    dates = df.select(*table_columns, "as_of_date").distinct()
    return dates.withColumn("yest_ingest_dt", F.lag("as_of_date").over(order))

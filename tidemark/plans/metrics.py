"""Metric report of a batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import as_date
from tidemark.operators.metrics_export import metrics_export
from tidemark.operators.previous_snapshot import previous_snapshot_dates
from tidemark.sinks.exports import write_delimited
from tidemark.sources import layout
from tidemark.sources.partition_dates import previous_stored_dates


def report_batch(
    counts: DataFrame,
    snapshots: Mapping[tuple[str, str], DataFrame | str],
    mapping: DataFrame,
    root: str,
    batch_type: str,
    as_of: dt.date | str,
) -> str:
    """Write the report of all tables of a batch for a date and return its path.

    ``snapshots`` tells by database and table where each mapped target is: its path or catalog
    name, of which the names of partitions are listed, or its history as a frame, of which the
    partitions of the last months are read. All tables share a job.
    """
    day = as_date(as_of)
    listed = {key: table for key, table in snapshots.items() if isinstance(table, str)}
    frames = {key: df for key, df in snapshots.items() if key not in listed}
    found = previous_snapshot_dates(frames, day) | previous_stored_dates(counts.sparkSession, listed, day)
    previous = counts.sparkSession.createDataFrame(
        [(*target, day, before) for target, before in found.items()],
        "dest_db string, dest_tbl string, as_of_date date, yest_ingest_dt date",
    )
    path = layout.metrics_export_path(root, str(day), batch_type)
    rows = counts.where(F.col("as_of_date") == F.lit(day))
    write_delimited(metrics_export(rows, previous, mapping), path)
    return path

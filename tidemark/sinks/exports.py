"""Files other programs pick up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidemark.functions.times import as_date
from tidemark.sinks.partitions import replace_partition


def write_delimited(report: DataFrame, path: str) -> None:
    """Bar-delimited text without a header: one file, or several where it grows large."""
    report.hint("rebalance").write.mode("overwrite").option("sep", "|").option("header", False).csv(path)


def write_lines(
    lines: DataFrame, root: str, as_of: dt.date | str, key: str, name: str
) -> int:
    """Text lines (column ``value``) of one date and one job or domain.

    A rerun replaces them, so no line is delivered twice.
    """
    return replace_partition(
        lines.select("value"), root, {"as_of_date": as_date(as_of), key: name}, "text"
    )

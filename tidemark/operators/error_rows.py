"""The common row shape of both quality checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.times import timestamp


def error_rows(
    findings: DataFrame, table: str, source_type: str, run_ts: dt.datetime | str
) -> DataFrame:
    """Complete (as_of_date, error_type, null_count, error_detail) to full error rows."""
    return findings.withColumns({
        "source_type": F.lit(source_type),
        "as_of_date": F.col("as_of_date").cast("date"),
        "lst_updt_ts": timestamp(run_ts),
        "tbl_nm": F.lit(table),
    }).select(*schemas.SQL_ERRORS.names)


def unfold(wide: DataFrame, results: list[tuple[Column, Column, Column]]) -> DataFrame:
    """One row per date and (error_type, null_count, error_detail) held side by side."""
    named = [
        (kind.alias("error_type"), count.alias("null_count"), detail.alias("error_detail"))
        for kind, count, detail in results
    ]
    if len(named) == 1:
        return wide.select("as_of_date", *named[0])
    return wide.select("as_of_date", F.inline(F.array(*[F.struct(*columns) for columns in named])))

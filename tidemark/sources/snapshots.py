"""Dated snapshots stored as Parquet, one directory per ``as_of_date``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import as_date, day_in


def read_or_nothing(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                    reader: DataFrameReader | None = None, **options: str) -> DataFrame:
    """Stored rows; none where nothing was ever written. ``reader`` is for other formats than Parquet."""
    try:
        reader = (reader or spark.read.format("parquet")).schema(schema).options(**options)
        return reader.load([path] if isinstance(path, str) else list(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_snapshot(
    spark: SparkSession, root: str, as_of: dt.date | str, schema: T.StructType
) -> DataFrame:
    """Rows of one snapshot; none when the date was never written.

    Only that date's directory is listed, so the length of the history does not matter.
    """
    day = as_date(as_of)
    rows = read_or_nothing(spark, f"{root}/as_of_date={day}", schema, basePath=root)
    return rows.where(rows.as_of_date == day_in(rows, day))


def read_snapshots(
    spark: SparkSession, root: str, days: Sequence[dt.date | str], schema: T.StructType
) -> DataFrame:
    """Rows of several snapshots in one scan; dates that were never written have none."""
    rows = read_or_nothing(spark, root, schema)
    return rows.where(F.col("as_of_date").isin([as_date(day) for day in days]))


def read_history(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Every snapshot; filter on ``as_of_date`` to prune directories.

    All directories are listed. Where the table is in a catalog, prefer
    ``spark.table``, which lists only what a filter leaves.
    """
    return spark.read.schema(schema).parquet(root)


def register_partitions(spark: SparkSession, table: str, days: Sequence[dt.date | str]) -> None:
    """Make written dates visible in a catalog table, all in one statement.

    Harmless for dates that already are. The parts of the name may need no quotes.
    """
    name = ".".join(f"`{part.strip('`')}`" for part in table.split("."))
    parts = " ".join(f"PARTITION (as_of_date = '{as_date(day)}')" for day in days)
    if parts:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        spark.catalog.refreshTable(name)

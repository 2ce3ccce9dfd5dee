"""Dates of stored snapshots from the names of partitions; no file of older dates is opened."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import as_date, day_in
from tidemark.sinks.files import Files

K = TypeVar("K")
KEY = "as_of_date"
# Fixed value: how a catalog shows the partition of rows without a key.
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def stored_days(spark: SparkSession, table: str, before: dt.date | str) -> list[dt.date]:
    """Days before a given one that have a partition, newest first; it may be empty.

    ``table`` is a path (with a slash), partitioned by date first, or the name of a catalog
    table partitioned by date. A path is listed one level deep, a catalog is asked for names.
    Partitions whose name is no date are passed over.
    """
    if "/" in table:
        names = Files(spark, table).names(folders=True)
    else:
        names = [row[0] for row in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()]
    found = set()
    for name in names:
        for part in name.split("/"):
            key, _, value = part.partition("=")
            if key == KEY:
                try:
                    found.add(dt.date.fromisoformat(value))
                except ValueError:
                    continue
    return sorted((day for day in found if day < as_date(before)), reverse=True)


def previous_stored_dates(
    spark: SparkSession, tables: Mapping[K, str], as_of: dt.date | str
) -> dict[K, dt.date | None]:
    """The latest earlier date with rows of every table, by path or catalog name.

    Only the newest partition of each table is looked into, for one row; where it is empty,
    the next one is. One job looks into all tables at once.
    """
    days = {key: stored_days(spark, table, as_of) for key, table in tables.items()}
    found: dict[K, dt.date | None] = dict.fromkeys(tables)
    while True:
        newest = {key: own[0] for key, own in days.items() if own and found[key] is None}
        if not newest:
            return found
        filled = _filled(spark, {key: (tables[key], day) for key, day in newest.items()})
        for key, day in newest.items():
            if key in filled:
                found[key] = day
            else:
                days[key] = days[key][1:]


def sync_partitions(spark: SparkSession, table: str, root: str) -> tuple[int, int]:
    """Make a catalog table over ``root`` know the dates that have a folder, and no others.

    Returns how many partitions were added and dropped. The two listings are compared as
    tables; each direction is one statement. Only the catalog changes. An emptied partition
    has its folder still and stays known.
    """
    pattern = rf"(?:^|/){KEY}=([^/]*)"
    known = spark.sql(f"SHOW PARTITIONS {quoted(table)}").select(
        F.regexp_extract("partition", pattern, 1).alias("day")).distinct()
    names = [(name,) for name in Files(spark, root).names(folders=True)]
    stored = spark.createDataFrame(names, "name string").select(
        F.regexp_extract("name", pattern, 1).alias("day")).where(
            F.expr("try_cast(day AS date)").isNotNull()).distinct()
    missing = [row.day for row in stored.join(known, "day", "left_anti").collect()]
    gone = [row.day for row in known.join(stored, "day", "left_anti").collect()]

    def listed(days: list[str], between: str) -> str:
        return between.join(f"PARTITION ({KEY} = '{dt.date.fromisoformat(day)}')" for day in sorted(days))

    gone = [day for day in gone if day != DEFAULT_PARTITION]
    if missing:
        spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS {listed(missing, ' ')}")
    if gone:
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS {listed(gone, ', ')}")
    if missing or gone:
        spark.catalog.refreshTable(table)
    return len(missing), len(gone)


def quoted(table: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in table.split("."))


def _filled(spark: SparkSession, partitions: Mapping[K, tuple[str, dt.date]]) -> set[K]:
    """Which partitions hold a row."""
    keys, looks = list(partitions), []
    for n, key in enumerate(keys):
        rows = _rows(spark, *partitions[key])
        if rows is not None:
            looks.append(rows.limit(1).select(F.lit(n).alias("n")))
    found = reduce(DataFrame.unionByName, looks).collect() if looks else []
    return {keys[row["n"]] for row in found}


def _rows(spark: SparkSession, table: str, day: dt.date) -> DataFrame | None:
    """Rows of a partition, without its columns; nothing if it has no file."""
    if "/" not in table:
        df = spark.table(table)
        return df.where(F.col(KEY) == day_in(df, day))
    folder = f"{KEY}={day}"
    files = Files(spark, table)
    if not [name for name in files.names(folder) if not name.startswith(("_", "."))]:
        return None
    # Of a column that no file has only the number of rows is read.
    return spark.read.schema("`-` string").option("recursiveFileLookup", True).parquet(f"{table.rstrip('/')}/{folder}")

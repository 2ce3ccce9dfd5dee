"""Replace partitions of a path table, and nothing else.

In both forms one job writes and counts. New files are staged and put in place once all are
written, so a query that fails leaves the old ones, and it may read the table it replaces.
Partitions that receive no row are emptied; all others keep what they hold. A driver lost on the
way leaves a journal by which the next run completes the change (``sinks/journal.py``).

Counting happens in the tasks that write the files: a task repeated after the loss of an
executor is then counted once, like its file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.sinks.journal import Replacement


def replace_partition(
    df: DataFrame,
    root: str,
    partition: Mapping[str, object],
    file_format: str = "parquet",
    max_rows_per_file: int = 0,
    also: Mapping[str, Column] | None = None,
) -> int | dict:
    """Make ``df`` the content of one partition and return its number of rows.

    The partition's values take the place of columns of that name. Rows are written as
    they come, without shuffle or sort. Values must not be null or empty: Spark gives both
    the same folder. ``also`` names further aggregates of the rows to observe in the tasks that
    write them; the result is then a dictionary of these and ``rows``.
    """
    _checked({key: [value] for key, value in partition.items()})
    rows = df.drop(*partition)
    written = Observation()
    # The values follow the observation, so that the writer sees them as constants.
    more = [value.alias(name) for name, value in (also or {}).items()]
    labelled = rows.observe(written, F.count(F.lit(1)).alias("rows"), *more).withColumns(
        {key: F.lit(value) for key, value in partition.items()}
    )
    only = {key: [value] for key, value in partition.items()}
    _write(labelled, root, only, file_format, max_rows_per_file)
    return written.get["rows"] if also is None else written.get


def replace_partitions(
    df: DataFrame,
    root: str,
    partitions: Mapping[str, Sequence],
    file_format: str = "parquet",
    max_rows_per_file: int = 0,
) -> int:
    """Make ``df`` the content of many partitions and return its number of rows.

    ``partitions`` lists the values of each key; every combination is replaced. A row
    outside them, one with a null or empty key included, fails the job before anything is
    replaced.
    """
    _checked(partitions)
    keys = list(partitions)
    outside = F.raise_error(F.lit("a row lies outside the partitions to replace"))
    rows = df.withColumn(
        keys[0], F.when(_listed(partitions), F.col(keys[0])).otherwise(outside)
    )
    written = Observation()
    observed = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    _write(observed, root, partitions, file_format, max_rows_per_file)
    return written.get["rows"]


def _write(
    df: DataFrame, root: str, partitions: Mapping[str, Sequence], file_format: str, max_rows_per_file: int
) -> None:
    change = Replacement(df.sparkSession, root, list(partitions), list(partitions.values()))
    try:
        (
            df.write.format(file_format)
            .option("maxRecordsPerFile", max_rows_per_file)
            .partitionBy(*partitions)
            .save(change.folder)
        )
    except BaseException:
        change.abandon()
        raise
    change.commit()


def _checked(partitions: Mapping[str, Sequence]) -> None:
    for key, values in partitions.items():
        if not values or any(value is None or value == "" for value in values):
            raise ValueError(f"partition key {key!r} needs values, none of them null or empty")


def _listed(partitions: Mapping[str, Sequence]) -> Column:
    return reduce(and_, [F.col(key).isin(*values) for key, values in partitions.items()])

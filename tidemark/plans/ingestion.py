"""Ingestion: replace a snapshot, then compare rows produced with rows readable."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession

from tidemark.functions.times import as_date
from tidemark.operators.reconcile import rows_print, stored_counts, transform_counts
from tidemark.sinks.partitions import replace_partition, replace_partitions
from tidemark.sources import layout
from tidemark.sources.mappings import mapped_tables
from tidemark.sources.snapshots import read_snapshot, register_partitions


class IngestionError(Exception):
    """Tables that could not be ingested, by name, with the error of each."""

    def __init__(self, failed: Mapping[str, Exception]) -> None:
        told = "; ".join(f"{name}: {error}" for name, error in sorted(failed.items()))
        super().__init__(f"{len(failed)} tables failed: {told}")
        self.failed = dict(failed)


def replace_snapshot(
    df: DataFrame,
    root: str,
    as_of: dt.date | str,
    files: int | None = None,
    max_rows_per_file: int = 0,
    also: Mapping[str, Column] | None = None,
) -> int | dict:
    """Make ``df`` the snapshot of a date and return how many rows it produced.

    Written as it is partitioned unless a number of files is asked for; a snapshot of
    many terabytes is better served by ``max_rows_per_file``, which needs no shuffle.
    ``also`` as in :func:`replace_partition`.
    """
    rows = df if files is None else df.repartition(files)
    return replace_partition(
        rows, root, {"as_of_date": as_date(as_of)}, max_rows_per_file=max_rows_per_file, also=also
    )


def replace_snapshots(
    df: DataFrame, root: str, days: Sequence[dt.date | str], max_rows_per_file: int = 0
) -> int:
    """Replace many dates at once from rows that carry their ``as_of_date``.

    Rows are rebalanced by date for well-sized files; a date that holds much of the data
    is split over several tasks.
    """
    return replace_partitions(
        df.hint("rebalance", "as_of_date"), root, {"as_of_date": [as_date(day) for day in days]},
        max_rows_per_file=max_rows_per_file,
    )


def write_transform_counts(
    counts: DataFrame, root: str, days: Sequence[dt.date | str], tables: Sequence[str]
) -> int:
    """Replace the metric rows of the given dates and tables."""
    return replace_partitions(
        counts.hint("rebalance", "as_of_date", "dest_tbl"), root, {"as_of_date": [as_date(day) for day in days], "dest_tbl": tables}
    )


def ingest_domain(
    spark: SparkSession,
    mapping: DataFrame,
    query: Callable[[str], DataFrame],
    root: str,
    domain: str,
    as_of: dt.date | str,
    run_ts: dt.datetime | str,
    files: int | None = None,
    register: bool = False,
    at_once: int = 4,
    compare_rows: bool = False,
) -> DataFrame:
    """Ingest every mapped table for a date and record the counts.

    ``query`` gives the rows of a target table; each table is one write job, some of
    which run side by side. With ``register`` the targets are catalog tables over their
    paths: the date is added to them and counted through them. Targets named twice are
    refused before anything is written. ``compare_rows`` reads the stored rows once more and
    says in a table's message whether they are the rows produced, not only as many.

    Once all tables are done, the metric rows of a database are stored in one write. A table that
    fails keeps its old snapshot and metric row and does not stop the others;
    :class:`IngestionError` names all that failed. Returns the metric rows, one a table, which take
    no further look at the data.
    """
    day = as_date(as_of)
    tables = mapped_tables(mapping, domain)
    named = [(row.target_database, row.target_folder, row.target_table) for row in tables]
    twice = sorted({".".join(target) for target in named if named.count(target) > 1})
    if twice:
        raise ValueError(f"mapped more than once: {', '.join(twice)}")

    def ingest(row: Row) -> tuple[dict, dict]:
        """What was produced and what is readable afterwards: numbers of rows, and their prints."""
        target = layout.snapshot_root(
            root, row.target_database, row.target_folder, row.target_table
        )
        df = query(row.target_table)
        prints = {"src_print": rows_print(df)} if compare_rows else {}
        made = replace_snapshot(df, target, day, files, also=prints)
        if register:
            name = f"{row.target_database}.{row.target_table}"
            register_partitions(spark, name, [day])
            readable = spark.table(name)
        else:
            schema = df.drop("as_of_date").schema.add("as_of_date", "date")
            readable = read_snapshot(spark, target, day, schema)
        stored = stored_counts(readable, row.target_database, row.target_table, day, compare_rows)
        return {"src_count": made["rows"], **made}, stored.first().asDict()

    def side(rows: Sequence[tuple[Row, dict]], name: str) -> DataFrame:
        columns = [f"{name}_count long"] + [f"{name}_print decimal(38,0)"] * compare_rows
        return spark.createDataFrame([
            (row.target_database, row.target_table, day, *[found[c.split()[0]] for c in columns])
            for row, found in rows], ", ".join(["dest_db string, dest_tbl string, as_of_date date", *columns]))

    def counts_of(rows: Sequence[tuple[Row, dict, dict]]) -> DataFrame:
        produced = side([(row, made) for row, made, _ in rows], "src")
        stored = side([(row, found) for row, _, found in rows], "dest")
        own = spark.createDataFrame([row for row, _, _ in rows], mapping.schema)
        return transform_counts(produced, stored, own, run_ts)

    done, failed = [], {}
    with ThreadPoolExecutor(at_once) as pool:
        started = {pool.submit(inheritable_thread_target(spark)(ingest), row): row for row in tables}
        for future in as_completed(started):
            row = started[future]
            try:
                done.append((row, *future.result()))
            except Exception as error:
                failed[f"{row.target_database}.{row.target_table}"] = error
    counts = []
    for database in sorted({row.target_database for row, _, _ in done}):
        own = [part for part in done if part[0].target_database == database]
        counts.append(counts_of(own))
        names = [row.target_table for row, _, _ in own]
        try:
            write_transform_counts(counts[-1], layout.transform_counts_root(root, database), [day], names)
        except Exception as error:
            failed |= {f"{database}.{name}": error for name in names}
    if failed:
        raise IngestionError(failed)
    return reduce(DataFrame.unionByName, counts)

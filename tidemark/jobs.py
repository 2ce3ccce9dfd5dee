"""The jobs as commands for spark-submit; the only place that reads the clock.

    spark-submit tidemark/jobs.py ingest --domain account --as-of 2024-01-15 ...
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.times import as_date
from tidemark.operators import READY, WAIT, classify_log, error_code
from tidemark.plans import (
    check_domain, check_quality, export_errors, ingest_domain, publish_status, report_batch,
)
from tidemark.schemas import SQL_ERRORS, TRANSFORM_COUNTS
from tidemark.sinks import write_lines
from tidemark.sources import (
    layout, quality_rules, read_ingestion_mapping, read_log, read_metric_mapping,
    read_or_nothing, read_rule_mapping, read_status, run_stored_query,
)


def ingest(spark: SparkSession, args: argparse.Namespace) -> int:
    mapping = read_ingestion_mapping(spark, args.mapping, args.domain, args.table)
    ingest_domain(
        spark, mapping, lambda table: run_stored_query(spark, args.queries, table, args.as_of),
        args.root, args.domain, args.as_of, args.run_ts, args.files, args.register,
    )
    return 0


def quality(spark: SparkSession, args: argparse.Namespace) -> int:
    # Known before anything is written.
    code = (args.code or error_code(args.domain)) if args.out else None
    rules = read_rule_mapping(spark, args.mapping, args.domain)
    check_quality(
        rules, lambda table: spark.table(f"{args.database}.{table}"),
        args.root, args.database, args.as_of, args.run_ts,
    )
    tables = {rule.table for rule in quality_rules(rules)}
    if args.out and tables:
        errors = read_or_nothing(spark, layout.sql_errors_root(args.root, args.database), SQL_ERRORS)
        export_errors(errors, args.out, [args.as_of], args.domain, sorted(tables), code)
    return 0


def _history(spark: SparkSession, name: str) -> str | DataFrame:
    """A table by name if its dates are partitions that can be listed, else its rows."""
    dated = any(c.name == "as_of_date" and c.isPartition for c in spark.catalog.listColumns(name))
    return name if dated else spark.table(name)


def metrics(spark: SparkSession, args: argparse.Namespace) -> int:
    mapping = read_metric_mapping(spark, args.mapping, args.batch, args.table)
    snapshots = {
        (row.target_database, row.target_table): _history(spark, f"{row.target_database}.{row.target_table}")
        for row in mapping.collect()
    }
    if not snapshots:
        return 0
    # Every database stores the counts of its own tables.
    counts = reduce(DataFrame.unionByName, [
        read_or_nothing(spark, layout.transform_counts_root(args.root, database), TRANSFORM_COUNTS)
        for database in sorted({database for database, _ in snapshots})
    ])
    report_batch(counts, snapshots, mapping, args.out, args.batch, args.as_of)
    return 0


def freshness(spark: SparkSession, args: argparse.Namespace) -> int:
    """Ends with 0 when the domain is ready, 2 when it must wait, 1 when it is too late."""
    status = read_status(spark, args.status)
    verdict = check_domain(status, args.out, args.domain, args.as_of, args.now)
    if verdict == READY:
        root = layout.table_status_root(args.root, args.database)
        publish_status(status, root, args.as_of, args.domain)
        return 0
    return 2 if verdict == WAIT else 1


def log(spark: SparkSession, args: argparse.Namespace) -> int:
    lines = classify_log(
        read_log(spark, *args.files), args.as_of, args.domain, args.job,
        upper_domain=args.upper_domain,
    )
    write_lines(lines, args.out, args.as_of, "job", f"{args.domain}_{args.job}")
    return 0


def parser() -> argparse.ArgumentParser:
    now = dt.datetime.now
    top = argparse.ArgumentParser(prog="tidemark")
    jobs = top.add_subparsers(required=True)

    def job(run, *required: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(run.__name__)
        added.set_defaults(run=run)
        added.add_argument("--as-of", type=as_date, required=True)
        for name in required:
            added.add_argument(f"--{name}", required=True)
        return added

    stamp = now().isoformat(sep=" ", timespec="seconds")
    added = job(ingest, "root", "mapping", "queries", "domain")
    added.add_argument("--table")
    added.add_argument("--files", type=int)
    added.add_argument("--register", action="store_true")
    added.add_argument("--run-ts", default=stamp)

    added = job(quality, "root", "mapping", "database", "domain")
    added.add_argument("--out")
    added.add_argument("--code")
    added.add_argument("--run-ts", default=stamp)

    added = job(metrics, "root", "mapping", "batch", "out")
    added.add_argument("--table")

    added = job(freshness, "root", "status", "database", "domain", "out")
    added.add_argument("--now", default=now(dt.UTC).replace(tzinfo=None))

    added = job(log, "domain", "job", "out")
    added.add_argument("--upper-domain", action="store_true")
    added.add_argument("files", nargs="+")
    return top


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.run(SparkSession.builder.appName("tidemark").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())

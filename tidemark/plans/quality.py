"""Quality run of a domain: every rule of every table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.times import as_date
from tidemark.operators.table_check import table_check
from tidemark.operators.text_lines import error_code, error_lines
from tidemark.sinks.partitions import replace_partitions
from tidemark.sources import layout
from tidemark.sources.mappings import QualityRule, quality_rules, rules_for


def run_quality(
    tables: Mapping[str, DataFrame],
    rules: Sequence[QualityRule],
    *,
    source_type: str,
    run_ts: dt.datetime | str,
    as_of: dt.date | str | None = None,
    type_column: str = "account_type",
) -> DataFrame:
    """All findings of the given rules as error rows.

    Each table is scanned once for its blank fields and its keys of numbers together, and
    once more per wide key (``table_check``). The parts are independent, so one action runs
    them side by side. Rules that check nothing find nothing.
    """
    options = dict(source_type=source_type, run_ts=run_ts, as_of=as_of, type_column=type_column)
    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        own = [rule for rule in rules_for(rules, table) if rule.null_fields or rule.duplicate_keys]
        if own:
            parts.append(table_check(tables[table], own, table=table, **options))
    if not parts:
        nothing = schemas.SQL_ERRORS
        return next(iter(tables.values())).sparkSession.createDataFrame([], nothing)
    return reduce(DataFrame.unionByName, parts)


def write_errors(
    errors: DataFrame, root: str, days: Sequence[dt.date | str], tables: Sequence[str]
) -> int:
    """Replace the error rows of the dates and tables that were checked.

    Tables without findings lose their earlier ones; other tables and dates are not
    touched. Returns the number of rows written.
    """
    return replace_partitions(
        errors.hint("rebalance", "as_of_date", "tbl_nm"), root, {"as_of_date": [as_date(day) for day in days], "tbl_nm": tables}
    )


def check_quality(
    mapping: DataFrame,
    table: Callable[[str], DataFrame],
    root: str,
    database: str,
    as_of: dt.date | str,
    run_ts: dt.datetime | str,
) -> int:
    """Run a domain's mapped rules for a date and replace its stored errors.

    ``table`` gives the rows of a table. Mapped tables lose their earlier errors of the date
    even where all their checks are switched off. Returns the number of error rows, 0 where
    no rule is mapped.
    """
    rules = quality_rules(mapping)
    tables = {name: table(name) for name in dict.fromkeys(rule.table for rule in rules)}
    if not tables:
        return 0
    errors = run_quality(tables, rules, source_type=database, run_ts=run_ts, as_of=as_of)
    return write_errors(errors, layout.sql_errors_root(root, database), [as_of], list(tables))


def export_errors(
    errors: DataFrame,
    root: str,
    days: Sequence[dt.date | str],
    domain: str,
    tables: Sequence[str],
    code: str | None = None,
) -> int:
    """Deliver the errors of a domain's tables as text lines; returns their number.

    ``code`` defaults to the one known for the domain. Lines delivered before for these
    dates are replaced.
    """
    code = code or error_code(domain)
    dates = [as_date(day) for day in days]
    wanted = errors.where(F.col("as_of_date").isin(*dates) & F.col("tbl_nm").isin(*tables))
    lines = error_lines(wanted, code).withColumn("domain", F.lit(domain))
    return replace_partitions(
        lines.hint("rebalance", "as_of_date", "domain"), root,
        {"as_of_date": dates, "domain": [domain]}, "text",
    )

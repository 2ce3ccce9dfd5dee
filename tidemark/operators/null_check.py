"""Count rows whose required fields are blank."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.blanks import any_blank
from tidemark.functions.scopes import null_scope
from tidemark.functions.times import day_in
from tidemark.operators.error_rows import error_rows, unfold
from tidemark.sources.mappings import QualityRule

# Fixed value: how a blank-field finding is labelled.
NULL_VALUES = "NULL_VALUES"


def null_check(
    df: DataFrame,
    rules: Sequence[QualityRule],
    *,
    table: str,
    source_type: str,
    run_ts: dt.datetime | str,
    as_of: dt.date | str | None = None,
    type_column: str = "account_type",
) -> DataFrame:
    """One row per rule, also when it finds nothing, from a single scan of ``df``.

    With ``as_of`` one snapshot is judged; without, every snapshot in ``df``, one row
    per rule and date. Only counters leave a task, so neither the number of rows nor
    their spread over dates matters to the shuffle.
    """
    rules = [rule for rule in rules if rule.null_fields]
    if not rules:
        raise ValueError("no rule names a field that must be filled")
    scopes = [null_scope(rule.overrides) for rule in rules]
    counters = [F.count_if(flag).alias(f"_n{i}") for i, flag in enumerate(blank_flags(df, rules, type_column))]
    if as_of is None:
        counted = df.groupBy("as_of_date").agg(*counters)
    else:
        day = day_in(df, as_of)
        rows = df.where(F.col("as_of_date") == day)
        if None not in scopes:
            # Rows outside every scope count nowhere; say so where the scan can use it.
            rows = rows.where(reduce(or_, [scope.condition(type_column) for scope in scopes]))
        counted = rows.agg(*counters).withColumn("as_of_date", day)
    results = [
        (F.lit(NULL_VALUES), F.col(f"_n{i}"), F.lit(",".join(rule.null_fields)))
        for i, rule in enumerate(rules)
    ]
    return error_rows(unfold(counted, results), table, source_type, run_ts)


def blank_flags(df: DataFrame, rules: Sequence[QualityRule], type_column: str = "account_type") -> list[Column]:
    """For each rule whether a row is in its scope and lacks a field; not true where the type is unknown."""
    scopes = [null_scope(rule.overrides) for rule in rules]
    blank = [any_blank(df, [name.strip() for name in rule.null_fields]) for rule in rules]
    return [b if scope is None else scope.condition(type_column) & b for scope, b in zip(scopes, blank)]

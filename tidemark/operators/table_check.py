"""All checks of a table from one scan: blank fields and repeated keys side by side."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.blanks import any_blank
from tidemark.functions.scopes import Scope, duplicate_scope, null_scope
from tidemark.functions.times import day_in
from tidemark.operators.duplicate_check import DUP_ERROR, duplicate_check, is_wide
from tidemark.operators.error_rows import error_rows
from tidemark.operators.null_check import NULL_VALUES, null_check
from tidemark.sources.mappings import QualityRule

#: Copies of a row that one scan may send to the aggregation; further keys share another scan.
MAX_SETS = 8
_FOUND = "array<struct<error_type:string,null_count:bigint,error_detail:string>>"


def table_check(
    df: DataFrame,
    rules: Sequence[QualityRule],
    *,
    table: str,
    source_type: str,
    run_ts: dt.datetime | str,
    as_of: dt.date | str | None = None,
    type_column: str = "account_type",
) -> DataFrame:
    """The rows of ``null_check`` and ``duplicate_check`` together, none where nothing is checked.

    Blank fields and keys of one or two numbers are grouping sets of one aggregation, so a
    table, or the query behind it, is read once. Each row is handed to it once per set, as
    flags and that set's key alone, and is combined within the task. Sets share their
    counters, so a key costs no more bytes to shuffle than by itself.

    Keys of text or of many columns stay with ``duplicate_check``, which shuffles their
    hashes: whole keys would cost more here than the scan that is saved. A table with a single
    check gains nothing either, and goes the plain way, where scopes can be pushed to the scan.
    """
    options = dict(table=table, source_type=source_type, run_ts=run_ts, as_of=as_of, type_column=type_column)
    blanks = [rule for rule in rules if rule.null_fields]
    keys = list(dict.fromkeys(rule.duplicate_keys for rule in rules if rule.duplicate_keys))
    wide = [key for key in keys if is_wide(df, key)]
    narrow = [key for key in keys if key not in wide]
    sets: list[tuple[str, ...] | None] = [*([None] if blanks else []), *narrow]
    parts = []
    for at in range(0, len(sets), MAX_SETS):
        shared = sets[at : at + MAX_SETS]
        own = [rule for rule in rules if rule.duplicate_keys in shared]
        if len(shared) > 1:
            parts.append(error_rows(_side_by_side(
                df, blanks if None in shared else [], [key for key in shared if key], own, as_of,
                type_column), table, source_type, run_ts))
        elif None in shared:
            parts.append(null_check(df, blanks, **options))
        else:
            parts.append(duplicate_check(df, own, **options))
    if wide:
        parts.append(duplicate_check(df, [rule for rule in rules if rule.duplicate_keys in wide], **options))
    if not parts:
        raise ValueError("no rule checks anything")
    return reduce(DataFrame.unionByName, parts)


def _side_by_side(
    df: DataFrame, blanks: list[QualityRule], keys: list[tuple[str, ...]], repeats: list[QualityRule],
    as_of: dt.date | str | None, type_column: str,
) -> DataFrame:
    """(as_of_date, error_type, null_count, error_detail) of all sets."""
    null_scopes = [null_scope(rule.overrides) for rule in blanks]
    scopes = {
        key: list(dict.fromkeys(duplicate_scope(r.overrides) for r in repeats if r.duplicate_keys == key))
        for key in keys
    }
    every = [*null_scopes, *(scope for own in scopes.values() for scope in own)]
    day = None if as_of is None else day_in(df, as_of)
    if day is not None:
        df = df.where(F.col("as_of_date") == day)
    if None not in every and day is not None:
        df = df.where(reduce(or_, [scope.condition(type_column) for scope in every]))

    # Flags and keys are made before the copies. Rows outside all scopes of a key count for nothing,
    # and take no key to the shuffle.
    flags = [[
        _true(any_blank(df, [n.strip() for n in rule.null_fields]), scope, type_column).alias(f"_b{i}")
        for i, (rule, scope) in enumerate(zip(blanks, null_scopes))
    ]]
    columns, groups = [], []
    for j, key in enumerate(keys):
        own = [_true(F.lit(True), scope, type_column) for scope in scopes[key]]
        inside = reduce(or_, own)
        flags.append([flag.alias(f"_s{j}_{i}") for i, flag in enumerate(own)])
        names = [f"_k{j}_{i}" for i in range(len(key))]
        columns += [F.when(inside, F.col(k)).alias(n) for k, n in zip(key, names)]
        groups.append(names)
    flat = df.select("as_of_date", *columns, *[flag for own in flags for flag in own])
    if day is not None:
        flat = flat.unionByName(_no_row(flat, day))

    sets = [["as_of_date"]] if blanks else []
    sets += [["as_of_date", *names] for names in groups]
    marks = {mark: place for place, mark in enumerate(_marks(sets, groups))}
    by_set = [[f"_b{i}" for i in range(len(blanks))]] if blanks else []
    by_set += [[f"_s{j}_{i}" for i in range(len(scopes[key]))] for j, key in enumerate(keys)]
    counters = []
    for n in range(max(map(len, by_set))):
        flag = F.lit(False)
        for mark, place in marks.items():
            if n < len(by_set[place]):
                flag = F.when(F.grouping_id() == mark, F.col(by_set[place][n])).otherwise(flag)
        counters.append(F.count_if(flag).alias(f"_n{n}"))
    counted = flat.groupingSets(
        [[F.col(name) for name in names] for names in sets], "as_of_date", *[n for g in groups for n in g]
    ).agg(F.grouping_id().alias("_set"), *counters)

    found = F.lit(None).cast(_FOUND)
    for mark, place in marks.items():
        if blanks and place == 0:
            results = [_result(F.lit(NULL_VALUES), i, F.lit(",".join(rule.null_fields)))
                       for i, rule in enumerate(blanks)]
        else:
            j = place - bool(blanks)
            results = [
                _result(F.lit(DUP_ERROR + ",".join(keys[j])), scopes[keys[j]].index(duplicate_scope(r.overrides)),
                        F.concat_ws(",", *groups[j]))
                for r in repeats if r.duplicate_keys == keys[j]
            ]
        found = F.when(F.col("_set") == mark, F.array(*results)).otherwise(found)
    repeated = reduce(or_, [F.col(f"_n{n}") > 1 for n in range(len(counters))])
    if blanks:
        repeated = repeated | (F.col("_set") == next(iter(marks)))
    return counted.where(repeated).select("as_of_date", F.inline(found)).where(
        (F.col("error_type") == NULL_VALUES) | (F.col("null_count") > 1))


def _true(flag: Column, scope: Scope | None, type_column: str) -> Column:
    """Never NULL: rows of unknown type are outside every scope."""
    return flag if scope is None else F.coalesce(flag & scope.condition(type_column), F.lit(False))


def _result(kind: Column, counter: int, detail: Column) -> Column:
    return F.struct(
        kind.alias("error_type"), F.col(f"_n{counter}").alias("null_count"), detail.alias("error_detail"))


def _marks(sets: list[list[str]], groups: list[list[str]]) -> list[int]:
    """The grouping id of each set: a bit for every grouping column it lacks, the first the highest."""
    names = ["as_of_date", *[name for group in groups for name in group]]
    return [sum((name not in own) << (len(names) - 1 - at) for at, name in enumerate(names)) for own in sets]


def _no_row(flat: DataFrame, day: Column) -> DataFrame:
    """A row of the date that counts nowhere, so that blank fields are also reported, as 0, without rows."""
    def nothing(field: T.StructField) -> Column:
        if field.name == "as_of_date":
            return day
        return F.lit(False) if field.name.startswith(("_b", "_s")) else F.lit(None).cast(field.dataType)

    return flat.sparkSession.range(1, numPartitions=1).select(
        [nothing(field).alias(field.name) for field in flat.schema])

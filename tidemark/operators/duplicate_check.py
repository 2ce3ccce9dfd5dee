"""Find keys that occur more than once in a snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scopes import duplicate_scope
from tidemark.functions.times import day_in
from tidemark.operators.error_rows import error_rows, unfold
from tidemark.sources.mappings import QualityRule

# Fixed value: how a duplicate finding is labelled, followed by the key columns.
DUP_ERROR = "DUP_ERROR:"


def duplicate_check(
    df: DataFrame,
    rules: Sequence[QualityRule],
    *,
    table: str,
    source_type: str,
    run_ts: dt.datetime | str,
    as_of: dt.date | str | None = None,
    type_column: str = "account_type",
) -> DataFrame:
    """One row per offending key, its group size as ``null_count``.

    NULL keys group together, and are left out of ``error_detail``. Rules on the same
    key share one aggregation. Rows are counted per key before the shuffle, so a key
    holding much of the table sends one partial count per task, not its rows.

    Keys of text or of many columns are counted by a 64-bit hash first, which is all that the
    clean ones shuffle; only rows of repeated hashes are then counted by their whole keys. This
    reads the key columns twice, so keys of one or two numbers are counted directly.
    """
    by_key: dict[tuple[str, ...], list[QualityRule]] = {}
    for rule in rules:
        if rule.duplicate_keys:
            by_key.setdefault(rule.duplicate_keys, []).append(rule)
    if not by_key:
        raise ValueError("no rule names a key that must be unique")
    if as_of is not None:
        df = df.where(F.col("as_of_date") == day_in(df, as_of))
    found = [_offending_keys(df, keys, group, type_column) for keys, group in by_key.items()]
    findings = reduce(DataFrame.unionByName, found)
    return error_rows(findings, table, source_type, run_ts)


def _offending_keys(
    df: DataFrame, keys: tuple[str, ...], rules: list[QualityRule], type_column: str
) -> DataFrame:
    scopes = list(dict.fromkeys(duplicate_scope(rule.overrides) for rule in rules))
    if None not in scopes:
        df = df.where(reduce(or_, [scope.condition(type_column) for scope in scopes]))
    sizes = [
        F.count(F.lit(1)) if scope is None or len(scopes) == 1
        else F.count_if(scope.condition(type_column))
        for scope in scopes
    ]
    sizes = [size.alias(f"_n{i}") for i, size in enumerate(sizes)]
    repeated = reduce(or_, [F.col(f"_n{i}") > 1 for i in range(len(sizes))])
    if is_wide(df, keys):
        df = _suspects(df, keys, sizes, repeated)
    columns = [f"_k{i}" for i in range(len(keys))]
    counted = df.groupBy(
        "as_of_date", *[F.col(key).alias(name) for key, name in zip(keys, columns)]
    ).agg(*sizes)
    kind, detail = F.lit(DUP_ERROR + ",".join(keys)), F.concat_ws(",", *columns)
    results = [
        (kind, F.col(f"_n{scopes.index(duplicate_scope(rule.overrides))}"), detail)
        for rule in rules
    ]
    return unfold(counted.where(repeated), results).where(F.col("null_count") > 1)


def is_wide(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a whole key takes clearly more room than its hash, and equal keys hash alike."""
    kinds = [field.dataType for field in df.select(*keys).schema]
    fixed = [isinstance(kind, T.NumericType | T.DatetimeType | T.BooleanType) for kind in kinds]
    # Text under a collation may be equal without being the same.
    plain = all(known or kind in (T.StringType(), T.BinaryType()) for kind, known in zip(kinds, fixed))
    return plain and (not all(fixed) or len(kinds) > 2)


def _suspects(
    df: DataFrame, keys: tuple[str, ...], sizes: list[Column], repeated: Column
) -> DataFrame:
    """Rows whose key hash occurs more than once in a scope; equal keys share their hash.

    Hashes are counted before the shuffle, like whole keys. The repeated ones are few where
    duplicates are rare, and are then sent to the rows; where they are many, rows meet them by
    hash, and adaptive execution splits a hot one.
    """
    marked = df.withColumn("_hash", F.xxhash64(*keys))
    often = marked.groupBy("as_of_date", "_hash").agg(*sizes).where(repeated)
    often = often.select(F.col("as_of_date").alias("_day"), F.col("_hash").alias("_often"))
    same = F.col("as_of_date").eqNullSafe(F.col("_day")) & (F.col("_hash") == F.col("_often"))
    return marked.join(often, same, "left_semi")

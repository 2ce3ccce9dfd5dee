"""Blank-field counts kept per file, so that a rerun reads only files it has not counted yet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scopes import null_scope
from tidemark.functions.times import as_date
from tidemark.operators.error_rows import error_rows, unfold
from tidemark.operators.null_check import NULL_VALUES, blank_flags
from tidemark.sources.mappings import QualityRule
from tidemark.sources.snapshots import read_or_nothing

KEPT = (
    T.StructType().add("path", "string").add("size", "long").add("time", "long").add("what", "string").add("n", "long"))
_FILE = ["path", "size", "time"]
_FILES = (
    T.StructType().add("path", "string").add("modificationTime", "timestamp").add("length", "long")
    .add("content", "binary").add("as_of_date", "date"))
_ROWS = "rows"


def kept_null_check(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    rules: Sequence[QualityRule],
    kept: str,
    *,
    table: str,
    source_type: str,
    run_ts: dt.datetime | str,
    as_of: dt.date | str | None = None,
    type_column: str = "account_type",
) -> DataFrame:
    """The rows of ``null_check`` over the snapshots below ``root``, from counts kept at ``kept``.

    Numbers of blank rows add up, so each is kept per file, keyed by the file's path, size and
    time of change and by what was counted. Only files that lack a count are read; files that
    are gone or were replaced fall out, as no listed file has their key. Listing opens no file.

    What is kept is a fact about a file that never changes. A run that is lost or repeated
    leaves too few counts or some twice, never wrong ones, and the folder may be deleted at any
    time. A file replaced while it is counted ends the run. The names of files pass through the
    driver, where Spark itself holds the names of all it is to read.
    """
    rules = [rule for rule in rules if rule.null_fields]
    if not rules:
        raise ValueError("no rule names a field that must be filled")
    whats = [_what(rule, type_column) for rule in rules]
    wanted = [*dict.fromkeys(whats), _ROWS]
    listed = _listed(spark, root, as_of)
    files = spark.createDataFrame(
        [(*key, day) for key, (day, _) in listed.items()],
        T.StructType([*KEPT.fields[:3], T.StructField("as_of_date", T.DateType())]))
    counted = files.join(_numbers(spark, kept, wanted), _FILE, "left")
    lacking = counted.where(F.array_contains(F.array(*[F.col(f"_n{i}").isNull() for i in range(len(wanted))]), True))
    fresh = {tuple(row): listed[tuple(row)] for row in lacking.select(*_FILE).collect()}
    if fresh:
        _count(spark, root, schema, dict(zip(whats, rules)), kept, fresh, type_column)
        if not fresh.keys() <= _listed(spark, root, as_of).keys():
            raise RuntimeError(f"{root}: files changed while they were counted")
        counted = files.join(_numbers(spark, kept, wanted), _FILE, "left")

    sums = [F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(wanted))]
    if as_of is None:
        # As in a full scan, a date is there if it has rows.
        by_day = counted.groupBy("as_of_date").agg(*sums).where(F.col(f"_n{wanted.index(_ROWS)}") > 0)
    else:
        by_day = counted.agg(*sums).na.fill(0).withColumn("as_of_date", F.lit(as_date(as_of)))
    results = [
        (F.lit(NULL_VALUES), F.col(f"_n{wanted.index(what)}"), F.lit(",".join(rule.null_fields)))
        for what, rule in zip(whats, rules)
    ]
    return error_rows(unfold(by_day, results), table, source_type, run_ts)


def _listed(spark: SparkSession, root: str, as_of: dt.date | str | None) -> dict[tuple, tuple]:
    """Key of each Parquet file of a date or all, with its date and plain path."""
    folder = root if as_of is None else f"{root}/as_of_date={as_date(as_of)}"
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = read_or_nothing(spark, folder, _FILES, reader, basePath=root)
    if not files.inputFiles():
        return {}
    rows = files.select(*_key(), "as_of_date", F.col("path").alias("plain")).collect()
    return {(row["path"], row["size"], row["time"]): (row["as_of_date"], row["plain"]) for row in rows}


def _key() -> list:
    return [
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.unix_micros("_metadata.file_modification_time").alias("time"),
    ]


def _what(rule: QualityRule, type_column: str) -> str:
    """The same for rules that count the same rows."""
    fields = sorted({name.strip() for name in rule.null_fields})
    scope = null_scope(rule.overrides)
    if scope is None:
        return repr(fields)
    return repr((fields, type_column, "in" if scope.keep else "not in", scope.types))


def _numbers(spark: SparkSession, kept: str, wanted: Sequence[str]) -> DataFrame:
    """``path``, ``size``, ``time`` and a number for each of ``wanted``, NULL where none is kept."""
    facts = read_or_nothing(spark, kept, KEPT).where(F.col("what").isin(*wanted))
    return facts.groupBy(*_FILE).agg(*[
        F.max(F.when(F.col("what") == what, F.col("n"))).alias(f"_n{i}") for i, what in enumerate(wanted)])


def _count(
    spark: SparkSession, root: str, schema: T.StructType, rules: dict[str, QualityRule], kept: str,
    fresh: dict[tuple, tuple], type_column: str,
) -> None:
    """Count the given files, read once, and add what was found; one row per file and task is shuffled."""
    read = spark.read.schema(schema).option("basePath", root).parquet(*[plain for _, plain in fresh.values()])
    flags = blank_flags(read, list(rules.values()), type_column)
    rows = read.select(*_key(), *[flag.alias(f"_n{i}") for i, flag in enumerate(flags)], F.lit(True).alias("_row"))
    # Files without a row are counted as well: each file adds a row that counts nowhere.
    none = spark.createDataFrame(list(fresh), T.StructType(KEPT.fields[:3])).select(
        *_FILE, *[F.lit(False).alias(f"_n{i}") for i in range(len(rules))], F.lit(False).alias("_row"))
    numbers = rows.unionByName(none).groupBy(*_FILE).agg(
        *[F.count_if(f"_n{i}").alias(f"_n{i}") for i in range(len(rules))], F.count_if("_row").alias("_row"))
    facts = F.array(*[
        F.struct(F.lit(what).alias("what"), F.col(name).alias("n"))
        for what, name in zip([*rules, _ROWS], [*[f"_n{i}" for i in range(len(rules))], "_row"])
    ])
    numbers.select(*_FILE, F.inline(facts)).hint("rebalance").write.mode("append").parquet(kept)

"""The three pipe-delimited mapping files: what to ingest, what to check, what to report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas

# Fixed value: the word that means "skip this check" in a rule file.
NO_CHECK = "None"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # The files are split on the bar alone: quotes are ordinary characters.
    rows = (
        spark.read.schema(schema)
        .option("sep", "|").option("header", True).option("quote", "")
        .csv(path)
    )
    return rows.na.fill("")


def _only(rows: DataFrame, column: str, wanted: str | None) -> DataFrame:
    return rows if wanted is None else rows.where(F.col(column) == wanted)


def read_ingestion_mapping(
    spark: SparkSession, path: str, domain: str | None = None, target_table: str | None = None
) -> DataFrame:
    """Tables to ingest for a domain or all, optionally one of them by name in any case."""
    rows = _only(_read(spark, path, schemas.INGESTION_MAPPING), "domain_name", domain)
    if target_table is not None:
        rows = rows.where(F.lower("target_table") == target_table.lower())
    return rows


def read_rule_mapping(spark: SparkSession, path: str, domain: str | None = None) -> DataFrame:
    """Quality rules of a domain or all, with the field and override lists split."""
    rows = _only(_read(spark, path, schemas.RULE_MAPPING), "domain", domain)
    return rows.select(
        F.col("input_fname").alias("target_table"),
        F.split("null_check", ",").alias("null_check"),
        "dup_check",
        "domain",
        F.split("dq_overrides", ",").alias("dq_overrides"),
    )


def read_metric_mapping(
    spark: SparkSession, path: str, batch_type: str | None = None, source_table: str | None = None
) -> DataFrame:
    """Tables to report for a batch or all, optionally one of them by exact source name."""
    rows = _only(_read(spark, path, schemas.METRIC_MAPPING), "batch_type", batch_type)
    return _only(rows, "source_table", source_table)


def mapped_tables(mapping: DataFrame, domain: str) -> list[Row]:
    """The mapping's rows, or an error when the domain or table is unknown.

    A mapping is a short hand-written list; no data rows pass through here.
    """
    tables = mapping.collect()
    if not tables:
        raise ValueError(f"no table is mapped for domain {domain!r}")
    return tables


@dataclass(frozen=True)
class QualityRule:
    """One line of a rule file: fields that must be filled, a key that must be unique."""

    table: str
    null_fields: tuple[str, ...] = ()
    duplicate_keys: tuple[str, ...] = ()
    overrides: tuple[str, ...] = ()


def quality_rules(mapping: DataFrame) -> list[QualityRule]:
    """Rules as objects, because they decide which columns a job selects.

    A rule file is a short hand-written list; no data rows pass through here.
    """
    def decode(row) -> QualityRule:
        skip_nulls = row.null_check[0] == NO_CHECK
        skip_duplicates = row.dup_check == NO_CHECK
        return QualityRule(
            table=row.target_table,
            null_fields=() if skip_nulls else tuple(row.null_check),
            duplicate_keys=() if skip_duplicates else tuple(row.dup_check.split(",")),
            overrides=tuple(row.dq_overrides),
        )

    return [decode(row) for row in mapping.collect()]


def rules_for(rules: Sequence[QualityRule], table: str) -> list[QualityRule]:
    return [rule for rule in rules if rule.table == table]

"""What several operators share: text units, row packing, intermediate tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.shared import shared_path

# The white space of the contracts, as a pattern and as characters.
SPACE = r"[\x20\x09-\x0D]"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def named(name: str) -> Column:
    """A column whose name may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns in one struct, so that no column an operator adds can clash with them."""
    return df.select(F.struct(*[named(c) for c in df.columns]).alias(name))


def unpacked(df: DataFrame, name: str = "row") -> DataFrame:
    return df.select([F.col(name).getField(c).alias(c) for c in df.schema[name].dataType.names])


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Maximal runs of characters that are no white space."""
    return F.filter(F.split(text, SPACE + "+"), lambda word: word != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Needed where it is neither installed nor on PYTHONPATH. On a cluster without a common file
    system ship it with ``--py-files`` instead.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    home = str(Path(__file__).resolve().parents[2])
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, home])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: lineage ends here, and sizes are known.

    The folder is left to whoever owns ``spark.checkpoint.dir``; a result that is still lazy
    reads it later.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""The upstream table list: which tables of which databases feed a domain.

A document is a JSON object holding ``defaults``, one entry of attributes per database
and, per domain, a map of database to table names. One document per row; a list spread
over many documents is treated as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each file as one document."""
    return spark.read.text(path, wholetext=True)


def read_document_lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line as one document."""
    return spark.read.text(path)


def _entries(documents: DataFrame) -> DataFrame:
    return documents.select(F.explode(F.from_json("value", "map<string,string>")))


def expand_tables(documents: DataFrame, domain: str | None = None) -> DataFrame:
    """One row per upstream table with its domain and its database's attributes.

    Of one domain or of all: an entry whose members are lists is a domain's, one with
    a ``db`` describes a database. A table whose database has no attributes, or different
    ones in different documents, raises when the row is read.
    """
    entries = _entries(documents).withColumn("found", F.from_json("value", schemas.DATABASE_ATTRIBUTES))
    described = F.coalesce(~F.startswith("found.db", F.lit("[")), F.lit(False))
    wanted = F.col("key") != "defaults" if domain is None else F.col("key") == domain
    tables = (
        entries.where(wanted & ~described)
        .select(F.col("key").alias("domain"), F.explode(F.from_json("value", "map<string,array<string>>")))
        .select("domain", F.col("key").alias("database"), F.explode("value").alias("table"))
    )
    # One row per database however often it is described, so the join cannot multiply tables.
    attributes = (
        entries.where(described)
        .groupBy(F.col("key").alias("database"))
        .agg(F.min("found").alias("found"), F.max("found").alias("other"))
    )

    def refused(why: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{why} database "), F.col("database")))

    db = (
        F.when(F.col("found").isNull(), refused("no attributes for"))
        .when(~F.col("found").eqNullSafe(F.col("other")), refused("conflicting attributes for"))
        .otherwise(F.col("found.db"))
    )
    return tables.join(attributes, "database", "left").select(
        "domain", "found.app_prefix", "found.pipeline", db.alias("db"), "table")


def poll_defaults(documents: DataFrame) -> DataFrame:
    """The settings shared by every table of the list."""
    return (
        _entries(documents)
        .where(F.col("key") == "defaults")
        .select(F.from_json("value", schemas.POLL_DEFAULTS).alias("found"))
        .select("found.*")
    )

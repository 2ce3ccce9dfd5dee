"""Exact duplicates by local, salted and global combining of whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named, stored, text_or_empty, unpacked

SALTS = 64


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 salts: int = SALTS) -> DataFrame:
    """One row per different text: ``digest``, ``keep_id``, ``group_size``.

    Each of the three combining steps groups by the digest *and* the whole text: tasks combine
    their own rows before the shuffle, a salt spreads the copies of one text over ``salts``
    tasks, and the winners of the salts are combined once more. A text that fills a third of
    the table thus sends one row per task and salt, and its group has at most ``salts`` rows.

    The largest id wins; a null id is smaller than any other. A null text counts as empty.
    Should two different texts ever share a SHA-256 digest, the job fails instead of
    mixing them up.
    """
    salt = F.pmod(F.xxhash64(named(id_column)), F.lit(salts))
    keyed = docs.select(
        named(id_column).alias("id"), text_or_empty(named(text_column)).alias("text"),
        salt.alias("salt"),
    ).withColumn("digest", _digest(F.col("text")))
    salted = keyed.groupBy("digest", "salt", "text").agg(
        F.max("id").alias("id"), F.count(F.lit(1)).alias("size")
    )
    # Dealt by digest, one shuffle serves both of the last steps.
    whole = salted.repartition("digest").groupBy("digest", "text").agg(
        F.max("id").alias("keep_id"), F.sum("size").alias("group_size")
    )
    return whole.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
        F.count(F.lit(1)).alias("texts"),
    ).select(
        "digest", "keep_id",
        F.when(F.col("texts") == 1, F.col("group_size"))
        .otherwise(F.raise_error(F.lit("two texts share a digest"))).alias("group_size"),
    )


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                salts: int = SALTS, columns: Sequence[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with what became of its text.

    ``columns`` names the columns the struct carries, by default all; leaving out the text
    keeps it out of the last shuffle. Adds ``digest`` (binary SHA-256 of the text), ``keep_id``, ``group_size``, ``kept``.
    A row is kept if its id is the group's ``keep_id``: rows that repeat one id with one text
    are one document and stay together. Texts that occur once need no partner: only groups of
    two and more are joined back, and adaptive execution splits a hot digest.
    """
    keyed = docs.select(
        F.struct(*[named(c) for c in columns or docs.columns]).alias("row"),
        named(id_column).alias("id"), _digest(text_or_empty(named(text_column))).alias("digest"),
    )
    # Stored, so that the join reads it as it is and a hot digest can be split.
    copies = stored(
        exact_groups(docs, id_column, text_column, salts).where("group_size > 1"), "copies")
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return keyed.join(copies, "digest", "left").select(
        "row", "digest", keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        keep_id.eqNullSafe(F.col("id")).alias("kept"),
    )


def without_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return unpacked(exact_dedup(docs, **options).where("kept"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))

"""A corpus pipeline: documents to token digests in five written stages.

Each stage reads all that its predecessor kept, and is written to the shared folder before the
next one starts, so a lost executor costs at most the running stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import find_package, stored
from tidemark.llm.line_dedup import without_common_lines
from tidemark.llm.mixing import mixed
from tidemark.llm.near_copies import without_similar
from tidemark.llm.quality_rules import without_junk
from tidemark.llm.queries import token_digests


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the limits or the outlier test reject go."""
    return without_junk(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more documents go from all of them; n_chars follows the text."""
    find_package(spark)
    return without_common_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 or more of five-word shingles) stays.

    SimHash fingerprints under covering masks find them, MinHash bands what these leave out.
    """
    find_package(spark)
    return without_similar(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text, for every row."""
    find_package(spark)
    return token_digests(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Byte-pair encoding and fingerprints of words are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)

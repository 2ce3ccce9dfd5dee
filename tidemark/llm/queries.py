"""One query per operator, over its whole table, with the digests that the contracts name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tidemark.llm.bpe import bpe_round_trip
from tidemark.llm.chat import canonical_turns, chat_format, read_back
from tidemark.llm.collocations import collocations
from tidemark.llm.common import find_package, text_or_empty
from tidemark.llm.embedding_graph import embedding_links
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.quality_classifier import quality_scores
from tidemark.llm.quality_rules import STATS, quality_rules
from tidemark.llm.simhash import as_hex, simhash
from tidemark.llm.toxicity import toxicity_scores
from tidemark.llm.turn_repair import damaged, repair_turns
from tidemark.llm.url_filter import ListRule, url_filter

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
URL_RULES = (
    ListRule("allow", "org", "/"),
    ListRule("block", "example.org", "/es/"),
    ListRule("block", "example.org", "/en/1"),
    ListRule("allow", "com", "/fr/"),
    ListRule("block", "com", "/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def held_out(parts: int, part: int) -> F.Column:
    """Rows no classifier learns from. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts == part


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = url_filter(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)
    return done.select("row.page_id", "host", "path", "rule", "verdict")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out(4, 2))
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = quality_scores(docs, labels, columns=["doc_id"])
    return scored.select("row.doc_id", "score").select(
        "doc_id", held_out(4, 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_digests(docs)


def token_digests(docs: DataFrame) -> DataFrame:
    coded = bpe_round_trip(docs, VOCABULARY)
    return coded.select(
        "doc_id", (F.length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return exact_dedup(docs, columns=["doc_id"]).select(
        "row.doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return line_dedup(docs).select(
        "row.doc_id", "n_lines", "n_dropped",
        F.sha2(text_or_empty("kept_text"), 256).alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash(docs).select(
        F.col("id").alias("doc_id"), as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    added = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
        F.to_variant_object(F.struct(F.array(*[
            F.struct(F.lit(role).alias("role"), F.lit(r"\### Assistant: </turn> ok").alias("content"))
            for role in ("user", "assistant")
        ]).alias("messages"))).alias("record"))
    records = turns.select(
        "conv_id", "turn", F.to_variant_object(F.struct("role", "text")).alias("record")
    ).unionByName(added)
    canonical = records.select(
        "conv_id", "turn", F.posexplode(canonical_turns(F.col("record")).getField("turns")))
    formatted = chat_format(canonical.select(
        "conv_id", F.struct("turn", "pos").alias("turn"), "col.role", "col.text"))
    back = formatted.select("conv_id", "formatted", read_back(F.col("formatted"), F.col("loss")).alias("back"))
    said = F.transform("back.turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("back.turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("back.loss").cast("long").alias("loss_chars"),
        F.sha2("back.loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return quality_rules(docs, columns=["doc_id"]).select("row.doc_id", *STATS, "base_failed", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mix(docs, columns=["doc_id"]).select(
        "row.doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out(5, 0))
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = toxicity_scores(docs, labels, columns=["doc_id"])
    return scored.select("row.doc_id", "score").select(
        "doc_id", held_out(5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
    repaired = repair_turns(damaged(turns)).withColumn("repaired", F.array_join(said, "\n"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = turns.select("conv_id").distinct().alias("c")
    return every.join(repaired, F.col("c.conv_id").eqNullSafe(repaired["conv_id"]), "left").select(
        "c.conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        text_or_empty("audit").alias("audit"),
        F.sha2(text_or_empty("repaired"), 256).alias("repaired_sha256"))


def op13_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return embedding_links(vectors).withColumnRenamed("id", "vec_id").select(
        "vec_id", "n_links", "component_id", "kept")


QUERIES = {
    query.__name__: query for query in (
        op1_url_filter, op2_quality_classifier, op3_bpe, op4_exact_dedup, op5_line_dedup,
        op6_simhash, op7_chat, op8_quality_rules, op9_mixing, op10_toxicity,
        op11_collocations, op12_turn_repair, op13_embedding_graph,
    )
}

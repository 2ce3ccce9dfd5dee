"""URL filters: a list of rules, and rules mined from labelled URLs with FP-growth."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, named, packed, stored, text_or_empty

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
DEFAULT = "allow"


class ListRule(NamedTuple):
    verdict: str
    host: str
    path: str


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty where the url is null or lacks ``://``."""
    text = text_or_empty(url)
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def list_rule(host: Column, path: Column, rules: Sequence[ListRule], field: str) -> Column:
    """``verdict`` or ``rule`` (host and path) of the longest rule that fits; null if none does.

    The list is configuration; each rule is one branch of an expression.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), r))
    chosen = F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = (
            (host == rule.host) | host.endswith(f".{rule.host}")
        ) & path.startswith(rule.path)
        value = rule.verdict if field == "verdict" else rule.host + rule.path
        chosen = F.when(fits, F.lit(value)).otherwise(chosen)
    return chosen


def url_tokens(host: Column, path: Column) -> Column:
    """Different labels of the host and words of the path, sorted, marked by where they stand."""
    def marked(text: Column, at: str, mark: str) -> Column:
        pieces = F.filter(F.split(text, at), lambda piece: piece != "")
        return F.transform(pieces, lambda piece: F.concat(F.lit(mark), piece))

    return F.array_sort(F.array_distinct(F.concat(
        marked(host, r"\.", "host:"), marked(path, r"[/._\-]", "path:"))))


def companions(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """``member`` and ``token``: frequent tokens that always occur with a lesser one, and the least of those.

    Tokens stand in the same rows if their number of rows and two sums of 64-bit hashes of the
    rows' sets of tokens are equal. Rows are summed per token before the shuffle.
    """
    seen = labelled.select(
        F.explode("tokens").alias("token"), F.xxhash64("tokens").cast("decimal(20)").alias("first"),
        F.xxhash64(F.lit("again"), "tokens").cast("decimal(20)").alias("second"))
    counted = seen.groupBy("token").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("first").alias("first"), F.sum("second").alias("second"))
    least = min_support * labelled.count()
    alike = counted.where(F.col("rows") >= least).groupBy("rows", "first", "second").agg(
        F.array_sort(F.collect_set("token")).alias("members")).where(F.size("members") > 1)
    return alike.select(
        F.explode(F.slice("members", 2, F.size("members"))).alias("member"), F.col("members")[0].alias("token"))


def mined_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT,
                min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``tokens``, ``verdict``, ``confidence``, ``support`` (rows), ``entry`` (the rarest token).

    ``labelled`` holds ``tokens`` and ``verdict``. FP-growth finds every combination that at
    least ``min_support`` of the rows contain, the verdict being one more item. A rule stays
    if its confidence reaches ``min_confidence`` and no rule with one token less and the
    same verdict is as sure. Combinations do not depend on the number of rows, but double with
    each token that often occurs with others; tokens that always occur together are therefore to be
    merged before (``companions``).
    """
    verdict_item = F.concat(F.lit("verdict:"), F.col("verdict"))
    items = labelled.select(F.concat("tokens", F.array(verdict_item)).alias("items"))
    grown = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(items)
    sets = stored(grown.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "url-sets")
    classed = sets.select(
        F.filter("items", lambda item: ~item.startswith("verdict:")).alias("tokens"),
        F.get(F.filter("items", lambda item: item.startswith("verdict:")), F.lit(0)).alias("item"),
        F.col("freq").alias("support"),
    ).where("item IS NOT NULL AND size(tokens) > 0") if sets.head(1) else None
    if classed is None:
        return labelled.sparkSession.createDataFrame(
            [], "tokens array<string>, verdict string, confidence double, support long, entry string")
    sure = stored(classed.join(
        sets.select(F.col("items").alias("tokens"), "freq"), "tokens"
    ).select(
        "tokens", F.substr("item", F.lit(len("verdict:") + 1)).alias("verdict"),
        (F.col("support") / F.col("freq")).alias("confidence"), "support",
    ).where(F.col("confidence") >= min_confidence), "url-rules")
    shorter = sure.select("tokens", "verdict", "confidence", F.explode("tokens").alias("left")).select(
        "tokens", "verdict", "confidence", F.array_remove("tokens", F.col("left")).alias("part"))
    part = sure.select(
        F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("of_part"))
    needless = shorter.join(part, ["part", "verdict"]).where("of_part >= confidence")
    rules = sure.join(needless.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti")
    single = sets.where("size(items) = 1").select(F.col("items")[0].alias("entry"), "freq")
    entries = rules.select("tokens", F.explode("tokens").alias("entry")).join(single, "entry").groupBy(
        "tokens").agg(F.min(F.struct("freq", "entry")).getField("entry").alias("entry"))
    return stored(rules.join(entries, "tokens").select(
        "tokens", "verdict", "confidence", "support", "entry"), "url-index")


def matched(token_sets: DataFrame, rules: DataFrame, merged: DataFrame | None = None) -> DataFrame:
    """``tokens`` and the ``mined`` verdict of the best rule that fits; no row without one.

    The rules are an inverted index: a URL meets only rules filed under one of its tokens, and
    a rule is filed under its rarest token, so a token of every URL draws few. With ``merged``
    (``member``, ``token``) a member stands for its token, once however many are there. The surest
    rule wins, then the better supported, the shorter, and of those a blocking one.
    """
    index = rules.select(F.col("tokens").alias("need"), "verdict", "confidence", "support", "entry")
    held = token_sets.select("tokens", F.col("tokens").alias("held"))
    if merged is not None:
        entries = token_sets.select("tokens", F.explode("tokens").alias("member")).join(merged, "member", "left")
        held = entries.groupBy("tokens").agg(F.collect_set(F.coalesce("token", "member")).alias("held"))
    met = held.select("tokens", "held", F.explode("held").alias("entry")).join(index, "entry")
    fits = met.where(F.size(F.array_except("need", "held")) == 0)
    best = F.max(F.struct("confidence", "support", (-F.size("need")).alias("short"), "verdict"))
    return fits.groupBy("tokens").agg(best.getField("verdict").alias("mined"))


def url_filter(pages: DataFrame, rules: Sequence[ListRule], labelled: DataFrame | None = None,
               url_column: str = "url", min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, default: str = DEFAULT) -> DataFrame:
    """Every row as the struct ``row``, with ``host``, ``path``, ``rule`` and ``verdict``.

    The list decides where a rule fits. Elsewhere mined rules do; they are learned from
    ``labelled`` (``url``, ``verdict``), by default from the rows that the list decides. Where no
    rule fits, and for urls that are null or lack ``://``, the verdict is ``default``. Equal
    sets of tokens are judged once. Empty tables give empty results.

    Labelled tokens that always occur together are mined as one, of which any is enough to fit:
    a rule that needs several of them is never surer than one that needs any, so no verdict
    changes. Their names pass through the driver: at most the mean number of tokens over
    ``min_support``.
    """
    def parts(df: DataFrame, url: Column) -> DataFrame:
        host, path = url_parts(url)
        return df.withColumns({"host": host, "path": path}).withColumns({
            "rule": list_rule(F.col("host"), F.col("path"), rules, "rule"),
            "listed": list_rule(F.col("host"), F.col("path"), rules, "verdict"),
            "tokens": url_tokens(F.col("host"), F.col("path")),
        })

    rows = parts(packed(pages), F.col("row").getField(url_column))
    if labelled is None:
        learned = rows.where("listed IS NOT NULL").select("tokens", F.col("listed").alias("verdict"))
    else:
        host, path = url_parts(named("url"))
        learned = labelled.where("verdict IS NOT NULL").select(
            url_tokens(host, path).alias("tokens"), "verdict")
    learned = stored(learned, "url-labels")
    merged = stored(companions(learned, min_support), "url-companions")
    needless = [row["member"] for row in merged.select("member").collect()]
    if needless:
        learned = learned.withColumn("tokens", F.filter("tokens", lambda token: ~token.isin(needless)))
    index = mined_rules(learned, min_support, min_confidence)
    open_sets = rows.where("listed IS NULL").select("tokens").distinct()
    found = stored(matched(open_sets, index, merged if needless else None), "url-found")
    return rows.join(found, "tokens", "left").select(
        "row", "host", "path", "rule",
        F.coalesce("listed", "mined", F.lit(default)).alias("verdict"),
    )

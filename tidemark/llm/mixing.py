"""Mix sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import packed, stored, text_or_empty, unpacked, word_count

BINS = 4096
MOST = 3
WEIGHTS = (1, 2, 3)


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0 and 1: the fewer marks like ``#`` or ``|`` per word, the heavier."""
    plain = F.regexp_replace(text, r"[#*$%&|<>!]+", "")
    marks = F.length(text) - F.length(plain)
    return F.when(size > 0, size / (size + marks)).otherwise(F.lit(1.0))


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             source_column: str = "source", seed: str = "mix",
             columns: Sequence[str] | None = None) -> DataFrame:
    """Every row as the struct ``row``, with ``source``, ``size``, ``bin`` and ``key``.

    ``columns`` names those that ``row`` holds, by default all.

    ``key`` is the exponential key -ln(u) / weight; u comes from a digest of id and text, so
    reruns agree and any task can derive it again. ``bin`` cuts 1 - exp(-key) evenly.
    """
    row = packed(docs)
    text = text_or_empty(F.col("row").getField(text_column))
    label = F.coalesce(F.col("row").getField(id_column).cast("string"), F.lit("-"))
    digest = F.md5(F.concat_ws(":", F.lit(seed), label, text))
    # 52 bits, so that u is an exact double and never 0.
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(2.0**52)
    sized = row.withColumns({
        "source": F.col("row").getField(source_column),
        "size": word_count(text),
        "u": u,
    })
    weighed = sized.withColumn("weight", quality_weight(text, F.col("size")))
    keyed = weighed.withColumn("key", -F.log("u") / F.col("weight"))
    kept = F.col("row") if columns is None else F.struct(*[F.col("row").getField(c).alias(c) for c in columns])
    return keyed.select(
        kept.alias("row"), "source", "size", "key",
        F.floor((1 - F.exp(-F.col("key"))) * BINS).cast("int").alias("bin"),
    )


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row per source.

    Sources in code point order, null last, get the weights in turn. All of the words are
    shared by weight; no target passes ``most`` times its source's size, and what that leaves
    is shared among the others by weight. Ordered by the weight at which each source
    reaches its limit, the limited ones come first, so running sums settle it in one pass.
    The windows see one row per source.
    """
    everything = Window.partitionBy()
    named = sizes.withColumn(
        "rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("rank") % len(weights) + 1).cast("int"),
    )
    limited = named.withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    order = everything.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shared = limited.withColumns({
        "total": F.sum("source_size").over(everything),
        "gone": F.coalesce(F.sum("limit").over(before), F.lit(0)),
        "open": F.sum("weight").over(onward),
    }).withColumn("level", (F.col("total") - F.col("gone")) / F.col("open"))
    # The first source that stays below its limit sets the level of all after it.
    free = F.col("level") * F.col("weight") <= F.col("limit")
    level = F.min(F.when(free, F.struct("gone", "level"))).over(everything).getField("level")
    return shared.select(
        "source", "source_size",
        F.least(F.col("limit").cast("double"), level * F.col("weight")).alias("target"),
    )


def mix_plan(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: size, target, complete epochs, and the last key of the rest.

    ``rows`` holds source, size, bin and key. Sums per source and bin give the prefix sums up
    to each bin; only rows of the one bin that a source's budget ends in are sorted. A source
    with a third of all rows is spread over all bins.
    """
    binned = stored(rows.groupBy("source", "bin").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")
    ), "mix-bins")
    sizes = targets(binned.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    budget = sizes.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(F.lit(1)).cast("int"),
    ).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    budget = stored(budget.coalesce(1), "mix-budget")

    by_bin = Window.partitionBy("source").orderBy("bin")
    before = F.coalesce(F.sum("words").over(by_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = binned.withColumn("before", before)
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    last = starts.alias("a").join(budget.alias("b"), same).where(
        (F.col("budget") > 0)
        & (F.col("before") <= F.col("budget")) & (F.col("before") + F.col("words") > F.col("budget"))
    ).select("a.source", "bin", "before", "budget")
    inside = rows.alias("a").join(
        last.alias("b"), same & (F.col("a.bin") == F.col("b.bin"))
    ).select("a.source", "size", "key", "before", "budget")
    # A row belongs if at least half of it fits, so the sum ends within half a document.
    by_key = Window.partitionBy("source").orderBy("key")
    earlier = F.coalesce(
        F.sum("size").over(by_key.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        - F.sum("size").over(Window.partitionBy("source", "key")), F.lit(0))
    fits = inside.withColumn("prefix", F.col("before") + earlier).withColumn(
        "fits", F.col("prefix") + F.col("size") / 2 <= F.col("budget")
    )
    cuts = fits.groupBy("source").agg(F.max(F.when(F.col("fits"), F.col("key"))).alias("cut"))
    edges = last.alias("a").join(cuts.alias("b"), same, "left").select("a.source", "bin", "cut")
    return budget.alias("a").join(edges.alias("b"), same, "left").select(
        "a.source", "source_size", "target", "epochs", "bin", "cut"
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST,
        id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source", seed: str = "mix",
        columns: Sequence[str] | None = None) -> DataFrame:
    """Every row as the struct ``row``, with size, source_size, target and ``copies``.

    ``copies`` says how often the mix takes the row: all complete epochs of its source, and
    once more if its key lies within the rest of the budget. Rows that repeat id and text share
    their key and are taken alike. Null ids, texts (no words) and sources (a source of their
    own, last) are ordinary values. An empty table gives an empty mix.

    With ``columns``, ``row`` holds only those; they are written with the sizes, so texts are
    read once. Without, texts are read again rather than written a second time.
    """
    rows = measured(docs, id_column, text_column, source_column, seed, columns)
    if columns is not None:
        rows = stored(rows, "mix-rows")
        return joined(rows, stored(mix_plan(rows, weights, most).coalesce(1), "mix-plan"))
    narrow = stored(rows.select("source", "size", "bin", "key"), "mix-rows")
    plan = stored(mix_plan(narrow, weights, most).coalesce(1), "mix-plan")
    return joined(rows, plan)


def joined(rows: DataFrame, plan: DataFrame) -> DataFrame:
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    # Without a last bin the budget is nothing, or all of the source.
    extra = F.when(F.col("b.bin").isNull(), F.lit(False)).otherwise(
        (F.col("a.bin") < F.col("b.bin"))
        | ((F.col("a.bin") == F.col("b.bin")) & F.coalesce(F.col("key") <= F.col("cut"), F.lit(False)))
    )
    return rows.alias("a").join(plan.alias("b"), same).select(
        "row", "size", "source_size", "target",
        (F.col("epochs") + extra.cast("int")).alias("copies"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``."""
    taken = mix(docs, **options).where("copies > 0")
    return unpacked(taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))))

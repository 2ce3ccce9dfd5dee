"""Quality rules: fixed limits, then robust multivariate outliers per language and source."""

from __future__ import annotations

from collections.abc import Sequence
from math import exp

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, bound, named, stored, text_or_empty, unpacked, words

MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
GROUP = ("lang", "source")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
AXES = ("q1", "q2", "q3", "q4")
#: Statistics are held as whole thousandths, so that sums are exact in any order.
GRID = 1000
#: A deviation of this size on an axis counts as one, however uniform a group is: 15 % in
#: word length, factors of 1.5 in the share of symbols, 1.8 and 1.9 in those of repeated lines
#: and words. Each axis alone must reach the limit for ``TAIL`` on texts that pass the fixed limits.
FLOOR = (0.15, 0.4, 0.6, 0.66)
#: Half of a group may be junk without moving its estimate.
SHARE = 0.5
STEPS = 4
#: Chance of a normal document lying further out than the limit.
TAIL = 1e-6
BIN = 16  # bins per unit of ln(1 + distance squared) x 16

_KEYS = [f"g_{name}" for name in GROUP]
_PAIRS = [(i, j) for i in range(len(AXES)) for j in range(i + 1)]


def statistics(text: Column) -> Column:
    """The five statistics of a text that is not null, as one struct.

    A repeated word lies in a window of three words that occurs twice or more in the text.
    Half of a window's hash and its place fit into one integer; sorted, these show which
    windows may be repeated, and only they are compared as texts, again sorted: time n log n.

    Values used inside lambdas are bound by ``bound``: were they columns, the optimizer could
    write their definitions into the lambda, to be evaluated for every element.
    """
    def marks(gram: Column) -> Column:
        high = F.lit(-(1 << 32))
        hashed = lambda i: F.xxhash64(F.get(gram, i), F.get(gram, i + 1), F.get(gram, i + 2))
        return F.when(F.size(gram) >= 3, F.sort_array(F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(gram) - 3, F.lit(0))),
            lambda i: hashed(i).bitwiseAND(high).bitwiseOR(i.cast("long")),
        ))).otherwise(F.array().cast("array<long>"))

    def suspects(ordered: Column) -> Column:
        def like_next(mark: Column, at: Column) -> Column:
            near = lambda by: F.shiftright(F.get(ordered, at + by).bitwiseXOR(mark), 32) == 0
            return F.coalesce(near(1), F.lit(False)) | ((at > 0) & F.coalesce(near(-1), F.lit(False)))

        return F.transform(
            F.filter(ordered, like_next), lambda mark: mark.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))

    def windows(gram: Column, at: Column) -> Column:
        return F.sort_array(F.transform(at, lambda i: F.struct(
            F.concat_ws(" ", F.get(gram, i), F.get(gram, i + 1), F.get(gram, i + 2)).alias("w"),
            i.alias("i"))))

    def places(ordered: Column) -> Column:
        def twice(window: Column, at: Column) -> Column:
            same = lambda by: F.coalesce(
                F.get(ordered, at + by).getField("w") == window.getField("w"), F.lit(False))
            return same(1) | ((at > 0) & same(-1))

        return F.transform(F.filter(ordered, twice), lambda window: window.getField("i"))

    def covered(at: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(
            F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    def repeated(gram: Column) -> Column:
        return bound(marks(gram), lambda m: bound(suspects(m), lambda at: F.when(
            F.size(at) > 0, bound(windows(gram, at), lambda w: bound(places(w), covered)),
        ).otherwise(F.lit(0))))

    def count_words(gram: Column) -> Column:
        return F.struct(
            F.size(gram).cast("long").alias("n_words"),
            F.length(F.array_join(gram, "")).cast("long").alias("word_chars"),
            repeated(gram).cast("long").alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE[1:]}"))
    counted = bound(words(text), count_words)
    return bound(counted, lambda x: F.struct(
        x.getField("n_words").alias("n_words"),
        x.getField("word_chars").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long")
        .alias("n_symbols"),
        bound(lines, lambda y: F.size(y) - F.size(F.array_distinct(y))).cast("long")
        .alias("n_dup_lines"),
        x.getField("n_repeat_words").alias("n_repeat_words"),
    ))


def base_failed(min_words: int = MIN_WORDS, most_repeated: int = MOST_REPEATED) -> Column:
    return (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def measured(docs: DataFrame, text_column: str = "text",
             columns: Sequence[str] | None = None) -> DataFrame:
    """Every row as the struct ``row``, with its group, statistics, ``base_failed`` and axes.

    The axes are logarithms of word length and of the shares (per cent) of symbols, repeated
    lines and repeated words, times ``GRID``, rounded.
    """
    text = text_or_empty(named(text_column))
    df = docs.select(
        F.struct(*[named(c) for c in columns or docs.columns]).alias("row"),
        *[named(name).alias(f"g_{name}") for name in GROUP], statistics(text).alias("_stats"),
    ).select("row", *_KEYS, "_stats.*")
    size = F.greatest(F.col("n_words"), F.lit(1))
    axes = (
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / size),
        *[F.log(1 + 100 * F.col(name) / size) for name in STATS[2:]],
    )
    return df.select(
        "row", *_KEYS, *STATS,
        base_failed().alias("base_failed"),
        *[F.round(axis * GRID).cast("long").alias(name) for name, axis in zip(AXES, axes)],
    )


def estimates(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """Location and scatter of every group: minimum covariance determinant, approximated by
    one start and a fixed number of steps, without a test of convergence.

    ``rows`` holds the group and the axes of the documents that pass the fixed limits. The
    start is the axis-wise median; each concentration step keeps the ``share`` of a group
    nearest to the last estimate and estimates again, which never raises the determinant.

    Ranks come from counts per group and bin of distance, so no group is ever sorted or
    gathered: every step sends at most one row per task, group and bin.
    """
    fit = _start(rows)
    for _ in range(steps):
        fit = stored(_concentrate(rows, fit, share), "mcd")
    return fit


def judged(rows: DataFrame, fit: DataFrame, tail: float = TAIL) -> DataFrame:
    """Adds ``distance`` (squared Mahalanobis) and ``kept`` to measured rows.

    A group without any row that passes the fixed limits has no estimate and keeps nothing.
    """
    far = _with_distance(rows, fit, "left")
    limit = chi_square_quantile(1 - tail)
    inside = F.coalesce(F.col("distance") <= limit, F.lit(False))
    # One condition on both sides of the join: a part on the rows alone would be pushed below
    # it and evaluate the statistics twice.
    return far.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(inside))


def quality_rules(docs: DataFrame, text_column: str = "text", share: float = SHARE,
                  steps: int = STEPS, tail: float = TAIL,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with statistics and verdict.

    The struct holds all columns. Given ``columns``, it holds these alone and is written with
    the statistics, so that texts are read once; otherwise only the statistics are written,
    and texts are read twice. ``docs`` needs columns ``lang`` and ``source``; their nulls are groups of their own. A
    null or empty text has no words and fails the limits. Groups of one document keep it.
    An empty table gives an empty result. Rows are independent, so repeated rows are judged
    alike.
    """
    rows = measured(docs, text_column, columns)
    if columns is None:
        axes = stored(rows.select(*_KEYS, *AXES, "base_failed"), "quality-axes")
    else:
        axes = rows = stored(rows, "quality-rows")
    return judged(rows, estimates(axes.where(~F.col("base_failed")), share, steps), tail)


def without_junk(docs: DataFrame, **options) -> DataFrame:
    """The rows that are kept, with the columns of ``docs``. Their texts are read twice."""
    return unpacked(quality_rules(docs, **options).where("kept"))


def chi_square_share(x: float, degrees: int) -> float:
    """P(chi square <= x) for an even number of degrees."""
    term, total = 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - exp(-x / 2) * total


def chi_square_quantile(share: float, degrees: int = len(AXES)) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_share(middle, degrees) < share else (low, middle)
    return high


def consistency(share: float) -> float:
    """Makes the scatter of the innermost share of normal data that of all of it."""
    degrees = len(AXES)
    return share / chi_square_share(chi_square_quantile(share, degrees), degrees + 2)


def _same(left: str = "a", right: str = "b") -> Column:
    first, second = (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in _KEYS)
    return first & second


def _start(rows: DataFrame) -> DataFrame:
    """The median on every axis, scaled by the floor alone."""
    each = rows.select(*_KEYS, F.explode(F.array(*[
        F.struct(F.lit(i).alias("axis"), F.col(name).alias("value")) for i, name in enumerate(AXES)
    ])).alias("x")).groupBy(*_KEYS, "x.axis", "x.value").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*_KEYS, "axis")
    upto = F.sum("n").over(group.orderBy("value"))
    medians = each.withColumns({"upto": upto, "total": F.sum("n").over(group)}).where(
        2 * F.col("upto") >= F.col("total")
    ).groupBy(*_KEYS, "axis").agg(F.min("value").alias("value"))
    wide = medians.groupBy(*_KEYS).agg(*[
        (F.max(F.when(F.col("axis") == i, F.col("value"))) / GRID).alias(f"m{i}")
        for i in range(len(AXES))
    ])
    scatter = {(i, j): F.lit(FLOOR[i] ** 2 if i == j else 0.0) for i, j in _PAIRS}
    return stored(_fit(wide, scatter), "mcd")


def _fit(wide: DataFrame, scatter: dict[tuple[int, int], Column]) -> DataFrame:
    """Group, location m0.. and the Cholesky factor l00, l10, l11.. of the scatter."""
    factor: dict[tuple[int, int], Column] = {}
    df = wide
    for i, j in _PAIRS:
        rest = scatter[i, j]
        for k in range(j):
            rest = rest - factor[i, k] * factor[j, k]
        df = df.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / factor[j, j])
        factor[i, j] = F.col(f"l{i}{j}")
    return df.select(
        *_KEYS, *[f"m{i}" for i in range(len(AXES))], *[f"l{i}{j}" for i, j in _PAIRS]
    )


def _with_distance(rows: DataFrame, fit: DataFrame, how: str = "inner") -> DataFrame:
    """Forward substitution with the factor; the squares of the solution add up."""
    fields = [c for c in fit.columns if c not in _KEYS]
    one = fit.select(*_KEYS, F.struct(*fields).alias("_fit"))
    df = rows.alias("a").join(one.alias("b"), _same(), how).select("a.*", "b._fit")
    value = lambda name: F.col("_fit").getField(name)
    for i, axis in enumerate(AXES):
        rest = F.col(axis) / GRID - value(f"m{i}")
        for k in range(i):
            rest = rest - value(f"l{i}{k}") * F.col(f"_z{k}")
        df = df.withColumn(f"_z{i}", rest / value(f"l{i}{i}"))
    parts = [F.col(f"_z{i}") * F.col(f"_z{i}") for i in range(len(AXES))]
    return df.withColumn("distance", sum(parts[1:], parts[0])).drop(
        "_fit", *[f"_z{i}" for i in range(len(AXES))])


def _concentrate(rows: DataFrame, fit: DataFrame, share: float) -> DataFrame:
    far = _with_distance(rows, fit).withColumn(
        "bin", F.floor(F.log(1 + F.col("distance")) * BIN * BIN).cast("long"))
    bins = far.groupBy(*_KEYS, "bin").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*_KEYS)
    edge = bins.withColumns({
        "upto": F.sum("n").over(group.orderBy("bin")), "total": F.sum("n").over(group),
    }).where(F.col("upto") >= F.ceil(F.lit(share) * F.col("total"))).groupBy(*_KEYS).agg(
        F.min("bin").alias("edge"))
    near = far.alias("a").join(edge.alias("b"), _same()).where("bin <= edge").select("a.*")
    moments = near.groupBy(*_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(name).alias(f"s{i}") for i, name in enumerate(AXES)],
        *[F.sum(F.col(AXES[i]) * F.col(AXES[j])).alias(f"s{i}{j}") for i, j in _PAIRS],
    )
    n = F.col("n").cast("double")
    wide = moments.select("*", *[(F.col(f"s{i}") / n / GRID).alias(f"m{i}") for i in range(len(AXES))])
    factor = consistency(share)
    scatter = {
        (i, j): (F.col(f"s{i}{j}") / n / (GRID * GRID) - F.col(f"m{i}") * F.col(f"m{j}")) * factor
        + (FLOOR[i] ** 2 if i == j else 0.0)
        for i, j in _PAIRS
    }
    return _fit(wide, scatter)

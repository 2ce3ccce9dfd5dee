"""Near copies by Jaccard similarity of word shingles.

SimHash fingerprints under covering masks find pairs, as in ``simhash``; MinHash bands find those that
differ in too many bits for that; exact sets judge all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named, stored
from tidemark.llm.simhash import SEED, components, covering_masks, majority, rooted, words_of, without_others

SHINGLE = 5
#: Least similarity, as a fraction of whole numbers: sizes are compared without rounding.
SIMILAR = (4, 5)
#: Fingerprints of 64 bits for each text: two that differ in no more than the radius of the masks in
#: one of them share a bucket.
PRINTS = 4
#: A pair at 0.8 shares no band of four minima with a chance of (1 - 0.8 ** 4) ** 28 = 4e-7.
BANDS, ROWS = 28, 4
#: Buckets of more texts are compared with one of theirs, and only what that may miss with each other.
MOST_IN_PAIRS = 16
BLOCK = 1 << 12  # shingles hashed at once

_random = np.random.default_rng(SEED)
_FLIPS = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None]
_FACTORS = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Different 64-bit hashes of all runs of ``size`` words, ascending; shorter texts are one run."""
    found = words_of(text)
    ends = range(max(len(found) - size + 1, 1)) if found else ()
    return np.unique(np.array(
        [xxhash.xxh64_intdigest(b" ".join(found[i : i + size]), SEED) for i in ends], np.uint64))


def band_keys(hashed: np.ndarray) -> list[int]:
    """One key for each band; a text without words has none."""
    if not len(hashed):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for start in range(0, len(hashed), BLOCK):  # bounds the memory of very long texts
        mixed = (hashed[start : start + BLOCK] ^ _FLIPS) * _FACTORS
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, (mixed * _FACTORS).min(axis=1))
    bands = least.reshape(BANDS, ROWS)
    return [_signed(xxhash.xxh64_intdigest(band.tobytes(), n)) for n, band in enumerate(bands)]


def prints(hashed: np.ndarray) -> list[int]:
    """SimHash fingerprints, each of other hashes of the shingles; a text without words has none."""
    if not len(hashed):
        return []
    found = [majority(hashed)]
    for flip, factor in zip(_FLIPS[: PRINTS - 1], _FACTORS):
        mixed = (hashed ^ flip) * factor
        mixed ^= mixed >> np.uint64(32)
        found.append(majority(mixed * factor))
    return found


def covers(marked: DataFrame) -> DataFrame:
    """``fp``, ``key``: one key for each fingerprint under each covering mask."""
    masked = [
        F.xxhash64(F.lit(n), "number", F.col("print").bitwiseAND(F.lit(_signed(mask))))
        for n, mask in enumerate(covering_masks(list(range(64))))
    ]
    return marked.select("fp", F.posexplode("prints").alias("number", "print")).select(
        "fp", F.explode(F.array(*masked)).alias("key"))


def word_hash(text: str | None) -> int:
    """Texts of the same words in the same order share it; 0 without a word."""
    found = words_of(text)
    return _signed(xxhash.xxh64_intdigest(b" ".join(found), SEED)) if found else 0


def links(marked: DataFrame, docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``a``, ``b``: links between different word hashes that connect whatever is similar.

    Texts that share a masked fingerprint or a band are compared exactly. Small buckets give their pairs. A large
    one gives the pairs of one member, its pivot, with all others, since a large bucket is as a
    rule one text with very many near copies. Pairs found by several bands are compared once, each by
    itself, so no worker holds a bucket of copies.

    Of a large bucket only those members are then gathered that the pivot may have missed a link
    of: the ones it is not similar to, and those close to them. The distance, one less the
    similarity, obeys the triangle inequality: members similar to each other differ by 0.2 at most
    in their distance to the pivot. So a copy at distance d goes if every member that is not similar
    to the pivot is farther from it than d + 0.2. The rest is compared by rare shingles.
    """
    one = marked.groupBy("fp").agg(F.min(F.struct("id", "hash", "keys", "prints")).alias("x")).select("fp", "x.*")
    keyed = covers(one).union(one.select("fp", F.explode("keys").alias("key"))).repartition("key")
    found = stored(
        keyed.sortWithinPartitions("key", "fp").mapInPandas(_pairs, "key long, a long, b long"),
        "near-pairs")
    wanted = stored(found.select("a", "b").distinct(), "near-pairs")
    members = wanted.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    places = one.join(members, "fp", "left_semi").select("id", "hash", "fp")
    texts = docs.select(
        named(id_column).alias("id"), F.xxhash64(named(text_column)).alias("hash"),
        named(text_column).alias("text")).alias("t")
    same = F.col("t.id").eqNullSafe(F.col("p.id")) & (F.col("t.hash") == F.col("p.hash"))
    # Rows that repeat id and text are the same text.
    sets = stored(texts.join(places.alias("p"), same).select(
        "fp", _sets(F.col("text")).alias("set")).dropDuplicates(["fp"]), "near-sets")
    a = sets.select(F.col("fp").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("fp").alias("b"), F.col("set").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    judged = stored(wanted.join(a, "a").join(b, "b").select(
        "a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b") - common).alias("all")), "near-judged")
    over, under = SIMILAR
    similar = judged.where(under * F.col("common") >= over * F.col("all")).select("a", "b")
    left = _missed(found.where("key is not null"), judged)
    whole = left.join(sets, "fp").repartition("key").sortWithinPartitions("key", "fp")
    return similar.union(whole.mapInPandas(_linked, "a long, b long").distinct())


def _missed(large: DataFrame, judged: DataFrame) -> DataFrame:
    """``key``, ``fp``: members of large buckets that may have links their pivot does not show.

    Counts of shingles are whole numbers, so distances are compared with room for rounding.
    """
    over, under = SIMILAR
    seen = large.join(judged, ["a", "b"]).select(
        "key", "a", "b", (1 - F.col("common") / F.col("all")).alias("far"),
        (under * F.col("common") < over * F.col("all")).alias("unlike"))
    nearest = seen.where("unlike").groupBy("key").agg(F.min("far").alias("nearest"))
    limit = F.lit(1 - over / under + 1e-9)
    return seen.join(nearest, "key").where(
        F.col("unlike") | (F.col("far") + limit >= F.col("nearest"))).select("key", F.col("b").alias("fp"))


def without_similar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each component of similar texts stays: the one with the smallest id.

    Two texts are similar if their sets of five-word shingles (A-Z lower-cased) have a Jaccard
    similarity of 0.8 or more; the comparison is exact, and a pair at 0.8 escapes it with a
    chance below 4e-7. Texts of the same words, and all null, empty and blank texts, are copies.
    Ties of ids are settled as by ``without_near_copies``.
    """
    def marks(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(t) for t in texts]
        return pd.DataFrame({
            "fp": np.array([word_hash(t) for t in texts], np.int64),
            "keys": [band_keys(s) for s in sets], "prints": [prints(s) for s in sets],
        })

    made = F.pandas_udf(marks, "fp long, keys array<long>, prints array<long>")(named(text_column))
    marked = stored(docs.select(
        named(id_column).alias("id"), F.xxhash64(named(text_column)).alias("hash"), made.alias("made"),
    ).select("id", "hash", "made.*"), "near-marks")
    roots = components(links(marked, docs, id_column, text_column), "near-components")
    places = marked.select("id", "hash", "fp")
    return without_others(docs, places, rooted(places, roots), id_column, text_column)


def _sets(text: Column) -> Column:
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t).view(np.int64) for t in texts])

    return F.pandas_udf(each, "array<long>")(text)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _buckets(batches: Iterator[pd.DataFrame], most: int | None = None) -> Iterator[pd.DataFrame]:
    """Whole buckets, as many as come at once; those of ``most`` members and more may come in parts."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        keys = held["key"].to_numpy()
        last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if most is not None and len(keys) - last >= most:
            last = len(keys)
        if last:  # the last bucket may go on
            yield held.iloc[:last]
            held = held.iloc[last:]
    if held is not None and len(held):
        yield held


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of small buckets, without a key; of large ones their pivot with each, with the key.

    The pivot is the first member, the one with the least hash; large buckets may arrive in parts.
    """
    pivot: tuple[int, int] | None = None  # of the bucket that goes on
    for df in _buckets(batches, MOST_IN_PAIRS + 1):
        keys, fps = df["key"].to_numpy(), df["fp"].to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        lengths = np.diff(np.r_[starts, len(keys)])
        firsts = fps[starts].copy()
        large = lengths > MOST_IN_PAIRS
        if pivot is not None and pivot[0] == keys[0]:
            firsts[0], large[0] = pivot[1], True
        pivot = (keys[-1], firsts[-1]) if large[-1] else None
        sizes, large = np.repeat(lengths, lengths), np.repeat(large, lengths)
        one, two = [], []
        for step in range(1, MOST_IN_PAIRS):
            at = np.flatnonzero((keys[step:] == keys[:-step]) & ~large[:-step] & (sizes[:-step] > step))
            one.append(fps[at])
            two.append(fps[at + step])
        one, two = np.concatenate(one), np.concatenate(two)
        yield pd.DataFrame({"key": pd.array([None] * len(one), "Int64"), "a": one, "b": two})
        heads = np.repeat(firsts, lengths)
        star = large & (heads != fps)
        yield pd.DataFrame({"key": pd.array(keys[star], "Int64"), "a": heads[star], "b": fps[star]})


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in _buckets(batches):
        keys = df["key"].to_numpy()
        fps, sets = df["fp"].to_numpy(), df["set"].to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        for lo, hi in zip(starts[:-1], starts[1:]):
            found = connected(sets[lo:hi])
            yield pd.DataFrame({"a": fps[lo:hi][found[:, 0]], "b": fps[lo:hi][found[:, 1]]})


def connected(sets: np.ndarray) -> np.ndarray:
    """Pairs of places that connect the sets as all similar pairs would.

    Of a set's members those in few other sets come first. Similar sets of sizes x and y share at
    least 0.8 of the larger, so each has one of the shared members among its first
    0.2 x + 1: sets without a common one there need no comparison, and a passage that all sets share
    comes last. Sets that are connected already are not compared either.
    """
    sizes = np.array([len(s) for s in sets])
    over, under = SIMILAR
    values, codes, often = np.unique(np.concatenate(list(sets)), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, often))] = np.arange(len(values))
    ranked = [np.sort(part) for part in np.split(rank[codes], np.cumsum(sizes)[:-1])]
    prefix = sizes - -(-over * sizes // under) + 1
    heads = np.concatenate([part[:n] for part, n in zip(ranked, prefix)])
    owner = np.repeat(np.arange(len(sets)), prefix)
    order = np.lexsort((sizes[owner], heads))
    heads, owner = heads[order], owner[order]
    cuts = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1], True])
    label, out, done = np.arange(len(sets)), [], set()
    members = {n: [n] for n in range(len(sets))}

    def compare(i: int, j: int) -> None:
        low, high = sorted((sizes[i], sizes[j]))
        if label[i] == label[j] or under * low < over * high or (i, j) in done:
            return
        done.add((i, j))
        common = len(np.intersect1d(ranked[i], ranked[j], assume_unique=True))
        if under * common >= over * (low + high - common):
            out.append((i, j))
            keep, gone = label[i], label[j]
            if len(members[keep]) < len(members[gone]):
                keep, gone = gone, keep
            label[members[gone]] = keep
            members[keep] += members.pop(gone)

    for lo, hi in zip(cuts[:-1], cuts[1:]):
        own = np.unique(owner[lo:hi]).tolist()
        for j in own[1:]:  # as a rule this connects all of them
            compare(own[0], j)
        for n, i in enumerate(own):
            others = np.array(own[n + 1 :], np.int64)
            for j in others[label[others] != label[i]].tolist():
                compare(i, j)
    return np.array(out, np.int64).reshape(-1, 2)

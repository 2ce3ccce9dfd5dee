"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, named, packed, stored, unpacked

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Buckets of more fingerprints are split by a second set of masks.
MOST_IN_BUCKET = 4096
PAIRS_AT_ONCE = 1 << 22

_WORD = re.compile(SPACE.replace("[", "[^").encode() + b"+")


def words_of(text: str | None) -> list[bytes]:
    """The words, A-Z lower-cased."""
    return _WORD.findall((text or "").encode().lower())


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 majority bits over the hashes of all shingles, repeats included; 0 without a word."""
    found = words_of(text)
    if not found:
        return 0
    ends = range(max(len(found) - shingle + 1, 1))
    return majority([xxhash.xxh64_intdigest(b" ".join(found[i : i + shingle]), SEED) for i in ends])


def majority(hashed: Sequence[int]) -> int:
    """64 bits, each set where it is in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashed), 1 << 16):  # bounds the memory of very long texts
        block = np.array(hashed[start : start + (1 << 16)], ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashed)).tobytes(), "big", signed=True)


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprints as signed 64-bit integers."""
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype=np.int64)

    return F.pandas_udf(each, "long")(text)


def as_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """2**(radius + 1) - 1 masks over the given bit positions.

    Each position gets a nonzero vector of radius + 1 bits in turn; the mask of a nonzero
    vector v takes the positions whose vector has an odd product with v. For any ``radius``
    positions some v is orthogonal to all their vectors, so its mask leaves them out: two
    values that differ there only agree under that mask.
    """
    vectors = 2 ** (radius + 1)
    return [
        sum(1 << bit for n, bit in enumerate(bits) if (((n % (vectors - 1)) + 1) & v).bit_count() % 2)
        for v in range(1, vectors)
    ]


def buckets(values: DataFrame, radius: int = RADIUS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """``t``, ``k1``, ``k2``, ``fp``: each fingerprint under every mask; equal keys are a bucket.

    Buckets of one fingerprint are of no use; those of more than ``most`` are split: their
    members differ only in the bits their mask leaves out, about 30, and masks over those leave
    14 free. A bucket thus has at most 2**14 members, and any two within the radius still
    share one.
    """
    first = covering_masks(list(range(64)), radius)
    signed = [_signed(m) for m in first]
    keyed = values.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k1"))
        for t, m in enumerate(signed)
    ])).alias("x")).select("fp", "x.*")
    sizes = stored(
        keyed.groupBy("t", "k1").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bucket-sizes")
    large = sizes.where(F.col("n") > most).select("t", "k1")
    small = keyed.join(sizes.where(F.col("n") <= most).select("t", "k1"), ["t", "k1"], "left_semi")
    second = [
        [_signed(m) for m in covering_masks([b for b in range(64) if not mask >> b & 1], radius)]
        for mask in first
    ]
    split = keyed.join(large, ["t", "k1"], "left_semi").select("t", "k1", "fp", F.posexplode(
        F.element_at(F.lit(second), F.col("t") + 1)
    ).alias("t2", "mask")).select(
        (F.col("t") + len(first) * (F.col("t2") + 1)).alias("t"), "k1",
        F.col("fp").bitwiseAND(F.col("mask")).alias("k2"), "fp",
    )
    return small.select("t", "k1", F.lit(0).cast("long").alias("k2"), "fp").union(split)


def links(values: DataFrame, radius: int = RADIUS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """``a``, ``b``: links between different fingerprints that connect whatever the radius connects.

    Within a bucket all pairs are compared, but each member is linked only to the smallest one
    that it is connected to: a bucket of n members gives fewer than n links.
    """
    def connect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            starts = _starts(held)
            if len(starts) > 1:  # the last bucket may go on
                yield _connected(held.iloc[: starts[-1]], radius)
                held = held.iloc[starts[-1] :]
        if held is not None:
            yield _connected(held, radius)

    keys = ["t", "k1", "k2"]
    dealt = buckets(values, radius, most).repartition(*keys).sortWithinPartitions(*keys, "fp")
    return dealt.mapInPandas(connect, "a long, b long").distinct()


def components(pairs: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``root``: every node of a link with the smallest node it is connected to.

    Rounds of two steps until nothing changes: every node's larger neighbours, then its smaller
    ones, are linked to the smallest instead. Trees become stars in a logarithmic number of
    rounds. Each round is a written table, so a lost executor costs no more than one.
    """
    edges = stored(pairs.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).where("u <> v").distinct(), name)
    before = None
    while True:
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
        edges = stored(_small_star(stored(_large_star(edges), name)), name)


def simhash(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            shingle: int = SHINGLE, radius: int = RADIUS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """``id``, ``fp``, ``component_id``: one row per row of ``docs``.

    A-Z are lower-cased. Fingerprints of ``radius`` or fewer differing bits link; a
    component's id is the smallest document id in it (null ids count only where there is no
    other). Null and empty texts have fingerprint zero, which links like any other. Copies share
    a fingerprint and are combined before anything is linked.
    """
    marked = stored(docs.select(
        named(id_column).alias("id"), fingerprints(named(text_column), shingle).alias("fp")
    ), "fingerprints")
    ids = components_of(marked, radius, most)
    return marked.join(ids, "fp").select("id", "fp", "component_id")


def components_of(marked: DataFrame, radius: int = RADIUS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """``fp``, ``root`` (the smallest fingerprint), ``component_id`` from rows of id and fp."""
    values = stored(marked.groupBy("fp").agg(F.min("id").alias("least_id")), "values")
    return _rooted(values, components(links(values.select("fp"), radius, most)))


def rooted(marked: DataFrame, roots: DataFrame) -> DataFrame:
    """As ``components_of``, from ``node`` and ``root`` of the linked fingerprints."""
    return _rooted(stored(marked.groupBy("fp").agg(F.min("id").alias("least_id")), "values"), roots)


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                        shingle: int = SHINGLE, radius: int = RADIUS,
                        most: int = MOST_IN_BUCKET) -> DataFrame:
    """One document of each component stays: the one with the smallest id.

    Rows that share the smallest id (or lack one) are settled by fingerprint, then text; of rows
    equal in these, one stays.
    """
    marked = stored(docs.select(
        named(id_column).alias("id"), fingerprints(named(text_column), shingle).alias("fp"),
        F.xxhash64(named(text_column)).alias("hash"),
    ), "fingerprints")
    return without_others(docs, marked, components_of(marked, radius, most), id_column, text_column)


def without_others(docs: DataFrame, marked: DataFrame, ids: DataFrame, id_column: str,
                   text_column: str) -> DataFrame:
    """The rows of ``docs`` that stay, from ``id``, ``fp``, ``hash`` of each and the components."""
    places = marked.join(ids, "fp")
    first = F.min(F.when(F.col("id").eqNullSafe(F.col("component_id")), F.struct("fp", "hash")))
    best = stored(places.groupBy("root").agg(first.alias("best")), "best")
    settled = places.join(best, "root").withColumn(
        "stays", F.col("id").eqNullSafe(F.col("component_id"))
        & (F.struct("fp", "hash") == F.col("best")))
    gone = stored(settled.where(~F.col("stays")).select("id", "hash"), "near-copies")
    alone = settled.where("stays").groupBy("root").count().where("count > 1").isEmpty()
    row = packed(docs).withColumns({
        "id": F.col("row").getField(id_column),
        "hash": F.xxhash64(F.col("row").getField(text_column)),
    })
    gone_too = row["id"].eqNullSafe(gone["id"]) & (row["hash"] == gone["hash"])
    kept = row.join(gone, gone_too, "left_anti")
    return unpacked(kept if alone else kept.dropDuplicates(["id", "hash"]))


def _rooted(values: DataFrame, roots: DataFrame) -> DataFrame:
    members = values.join(roots, values["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = stored(members.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    return stored(members.join(least, "root").select("fp", "root", "component_id"), "components")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _starts(df: pd.DataFrame) -> np.ndarray:
    keys = df[["t", "k1", "k2"]].to_numpy()
    return np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(df) else np.array([])


def _connected(df: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Links of whole buckets, some millions of pairs at a time."""
    starts = _starts(df)
    sizes = np.diff(np.r_[starts, len(df)])
    fps = df["fp"].to_numpy().view(np.uint64)
    done = np.cumsum(sizes * (sizes - 1) // 2) // PAIRS_AT_ONCE
    cuts = np.r_[0, np.flatnonzero(np.diff(done)) + 1, len(starts)].astype(np.int64)
    out = []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi > lo:
            begin = int(starts[lo])
            end = int(starts[hi]) if hi < len(starts) else len(df)
            out.append(_stars(fps[begin:end], sizes[lo:hi], radius))
    found = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
    return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})


def _stars(fps: np.ndarray, sizes: np.ndarray, radius: int) -> np.ndarray:
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(fps)) - 1  # members that follow
    one, two = [], []
    for step in range(1, int(sizes.max(initial=1))):
        at = np.flatnonzero(left >= step)
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= radius]
        one.append(near)
        two.append(near + step)
    label = np.arange(len(fps))
    if one:
        a, b = np.concatenate(one), np.concatenate(two)
        while True:
            least = np.minimum(label[a], label[b])
            then = label.copy()
            np.minimum.at(then, a, least)
            np.minimum.at(then, b, least)
            then = then[then]
            if (then == label).all():
                break
            label = then
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return np.stack([fps[moved].view(np.int64), fps[label[moved]].view(np.int64)], axis=1)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()

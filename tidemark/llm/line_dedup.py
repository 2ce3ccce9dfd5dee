"""Lines that many documents share: Bloom filters first, exact counts for the suspects."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_BYTES, named, packed, stored, unpacked

MIN_DOCS = 10
LINES_PER_DOC = 32
BITS_PER_LINE = 8
#: Largest filter in bits: 64 MB to broadcast. Beyond it more lines are suspected, none lost.
MAX_BITS = 1 << 29
SLICE = 1 << 19  # bits of a filter that travel in one row
FAN_IN = 64  # partial filters merged by one task


def line_key(line: bytes) -> bytes:
    """Stripped of white space at both ends, A-Z lower-cased; bytes.lower leaves other letters."""
    return line.strip(SPACE_BYTES).lower()


def line_keys(text: str | None) -> list[bytes]:
    return [line_key(line) for line in (text or "").encode().split(b"\n")]


def filter_bits(n_docs: int, lines_per_doc: int = LINES_PER_DOC, max_bits: int = MAX_BITS) -> int:
    """Grows with the corpus, by powers of two, up to the bound."""
    wanted = max(n_docs, 1) * lines_per_doc * BITS_PER_LINE
    return int(min(max_bits, max(SLICE, 2 ** ceil(log2(wanted)))))


def repeated_filter(docs: DataFrame, bits: int, text_column: str = "text",
                    min_length: int = 1) -> list[tuple[int, bytes]]:
    """The filter of keys seen in two or more rows, as (slice, packed bits); no false negative.

    Each task fills two filters over its own rows: once-seen and twice-seen. Two pairs merge
    to (a | b, twice a | twice b | a & b), which may be done in any order, so ``FAN_IN``
    pairs of a slice at a time are merged until one is left: no task gathers all partial
    filters. What reaches the driver is at most ``bits`` / 8 bytes.
    """
    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        part = -1
        for batch in batches:
            part = batch["part"].iloc[0]
            keys = [
                key for text in batch["text"] for key in set(line_keys(text))
                if _long_enough(key, min_length)
            ]
            halves = _halves(keys)
            _, first, counts = np.unique(halves[0], return_index=True, return_counts=True)
            at = _places(halves[:, first], bits)
            again = (counts > 1) | _held(once, at)
            np.bitwise_or.at(twice, at[:, again] >> 3, _bit(at[:, again]))
            np.bitwise_or.at(once, at >> 3, _bit(at))
        step = SLICE // 8
        for n in range(0, bits // 8, step):
            if once[n : n + step].any():
                yield pd.DataFrame({
                    "part": [part], "slice": [n // step],
                    "once": [_pack(once[n : n + step])], "twice": [_pack(twice[n : n + step])],
                })

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(SLICE // 8, np.uint8), np.zeros(SLICE // 8, np.uint8)
        for a, b in zip(group["once"], group["twice"]):
            a, b = _unpack(a), _unpack(b)
            twice |= b | (once & a)
            once |= a
        return pd.DataFrame({
            "part": [group["part"].iloc[0]], "slice": [group["slice"].iloc[0]],
            "once": [_pack(once)], "twice": [_pack(twice)],
        })

    schema = "part long, slice long, once binary, twice binary"
    texts = docs.select(
        F.spark_partition_id().cast("long").alias("part"), named(text_column).alias("text"))
    partial = stored(texts.mapInPandas(fill, schema), "line-filters")
    parts = (partial.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        lower = partial.withColumn("part", F.floor(F.col("part") / FAN_IN))
        partial = stored(lower.groupBy("slice", "part").applyInPandas(merge, schema), "line-filters")
        parts = ceil(parts / FAN_IN)
    return [(row["slice"], zlib.decompress(row["twice"]))
            for row in partial.select("slice", "twice").collect()]


def suspects(docs: DataFrame, bits: int, slices: list[tuple[int, bytes]], row_key: list[Column],
             text_column: str = "text", min_length: int = 1) -> DataFrame:
    """``row_key`` columns and ``key``: once for each row and different key that the filter holds."""
    seen = np.zeros(bits // 8, np.uint8)
    for n, data in slices:
        seen[n * SLICE // 8 : (n + 1) * SLICE // 8] = np.frombuffer(data, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def find(texts: pd.Series) -> pd.Series:
        seen = shared.value
        found = []
        for text in texts:
            keys = [k for k in dict.fromkeys(line_keys(text)) if _long_enough(k, min_length)]
            held = _held(seen, _places(_halves(keys), bits))
            found.append([key for key, yes in zip(keys, held) if yes])
        return pd.Series(found)

    keys = F.pandas_udf(find, "array<binary>")(named(text_column))
    return docs.select(*row_key, F.explode(keys).alias("key"))


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_length: int = 1,
               keep_first: bool = False, id_column: str = "doc_id",
               text_column: str = "text", lines_per_doc: int = LINES_PER_DOC,
               max_bits: int = MAX_BITS) -> DataFrame:
    """Every row as the struct ``row``, with ``kept_text``, ``n_lines``, ``n_dropped``.

    A line's key has white space stripped and A-Z lower-cased. Keys of ``min_length`` code
    points or more that ``min_docs`` rows hold lose their lines everywhere; with
    ``keep_first`` the first such line in the document with the smallest id stays. Null and
    empty texts are one empty line. Repeated rows count as documents of their own.

    Only suspected keys are shuffled, combined within tasks first. Decisions return to the
    documents by id and a hash of the text; a clash of hashes merely hands a document keys
    that are dropped everywhere anyway. Documents that lose nothing keep their text as it is.
    """
    bits = filter_bits(docs.count(), lines_per_doc, max_bits)
    slices = repeated_filter(docs, bits, text_column, min_length)
    row_key = [named(id_column).alias("id"), F.xxhash64(named(text_column)).alias("hash")]
    found = stored(suspects(docs, bits, slices, row_key, text_column, min_length), "line-suspects")
    place = F.struct("id", "hash")
    first = F.min(place) if keep_first else F.first(F.lit(None).cast("boolean"))
    common = found.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), first.alias("first")
    ).where(F.col("n") >= min_docs).drop("n")
    hit = found.join(stored(common, "line-common"), "key").select(
        "id", "hash", "key",
        (F.col("first").eqNullSafe(place) if keep_first else F.lit(False)).alias("is_first"),
    )
    drops = hit.groupBy("id", "hash").agg(
        F.collect_set("key").alias("keys"),
        F.collect_set(F.when(F.col("is_first"), F.col("key"))).alias("firsts"),
    )

    def cut(parts: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for text, keys, firsts in zip(parts["text"], parts["keys"], parts["firsts"]):
            lines = (text or "").encode().split(b"\n")
            drop = set(keys) if keys is not None else ()
            spare = set(firsts) if keep_first and firsts is not None else set()
            kept = []
            for line in lines if drop else ():
                key = line_key(line)
                if key not in drop or key in spare:
                    kept.append(line)
                    spare.discard(key)
            whole = not drop or len(kept) == len(lines)
            rows.append((text if whole else b"\n".join(kept).decode(), len(lines),
                         0 if whole else len(lines) - len(kept)))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    row = packed(docs)
    parts = F.struct(
        F.col("row").getField(text_column).alias("text"), F.col("keys"), F.col("firsts"))
    done = F.pandas_udf(cut, "text string, n_lines long, n_dropped long")(parts)
    same = F.col("row").getField(id_column).eqNullSafe(F.col("id")) & (
        F.xxhash64(F.col("row").getField(text_column)) == F.col("hash"))
    return row.join(drops, same, "left").select("row", done.alias("done")).select(
        "row", F.col("done.text").alias("kept_text"), "done.n_lines", "done.n_dropped")


def without_common_lines(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars",
                         **options) -> DataFrame:
    """``docs`` with the remaining text; ``length_column``, if present, follows it."""
    done = line_dedup(docs, text_column=text_column, **options)
    length = F.length("kept_text").cast("long")
    lengths = F.when(F.col("n_dropped") > 0, length).otherwise(F.col("row").getField(length_column))
    fields = {text_column: F.col("kept_text")}
    if length_column in docs.columns:
        fields[length_column] = lengths
    names = docs.columns
    return unpacked(done.select(F.struct(*[
        fields.get(n, F.col("row").getField(n)).alias(n) for n in names
    ]).alias("row")))


def _long_enough(key: bytes, min_length: int) -> bool:
    return len(key) >= min_length and (min_length < 2 or len(key.decode()) >= min_length)


def _halves(keys: list[bytes]) -> np.ndarray:
    """The 128-bit hash of each key (the columns) as two halves."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<u8").reshape(-1, 2).T


def _places(halves: np.ndarray, bits: int) -> np.ndarray:
    """Three places of each key in a filter whose size is a power of two."""
    steps = np.arange(3, dtype=np.uint64)[:, None]
    places = halves[0] + steps * (halves[1] | np.uint64(1))
    return (places & np.uint64(bits - 1)).astype(np.int64)


def _bit(at: np.ndarray) -> np.ndarray:
    return np.uint8(1) << (at & 7).astype(np.uint8)


def _held(seen: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether all places of a key are set."""
    return (seen[at >> 3] & _bit(at)).all(axis=0)


def _pack(flags: np.ndarray) -> bytes:
    return zlib.compress(flags.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8)

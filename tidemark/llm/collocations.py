"""Phrases that occur far more often than their parts would by chance, counted in HAT-tries."""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, named, stored, text_or_empty

# Where texts are cut into pieces, and the language of texts that name none.
CUTS = b".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
LONGEST = 5
LEAST = 100
#: A phrase goes when a longer one has at least this many hundredths of its occurrences.
SHARE = 100
TOP = 2000
#: Entries of a hash container before it bursts; of all containers of a task before some spill.
BURST = 4096
MOST_ENTRIES = 1 << 20
#: Different words a task numbers before it starts anew.
MOST_WORDS = 1 << 20
TOKENS_AT_ONCE = 1 << 21
ROWS_AT_ONCE = 1 << 16
#: Bits of a broadcast filter. More frequent phrases than it holds are taken in several passes.
MAX_BITS = 1 << 28
BITS_EACH = 16

_RUNS = "lang string, phrase string, n long"
_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
_TABLE = bytes.maketrans(UPPER.encode() + CUTS, LOWER.encode() + b"." * len(CUTS))


class Node(dict):
    """A burst container: word id to what follows it, a container or another node."""


class HatTrie:
    """Counts of word-id sequences of one length.

    Hash containers hold the rest of a sequence, packed (one last id: as a number), below the word
    ids that lead to them. One that outgrows ``burst`` entries becomes a node with a container for
    each next word. Beyond ``most`` entries the largest subtrees leave as sorted runs, whole,
    until half is free.
    """

    def __init__(self, burst: int = BURST, most: int = MOST_ENTRIES):
        self.burst, self.most = burst, most
        self.root: dict = {}
        self.entries = 0

    def add(self, sequences: np.ndarray, counts: np.ndarray) -> None:
        """Different sequences, one a row, sorted by id, and how often each was seen."""
        if len(sequences):
            self.root = self._put(self.root, np.ascontiguousarray(sequences, np.int32), counts)

    def _put(self, at: dict, rows: np.ndarray, counts: np.ndarray) -> dict:
        if isinstance(at, Node):
            heads, rest = rows[:, 0], np.ascontiguousarray(rows[:, 1:])
            cuts = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1], True]).tolist()
            for word, lo, hi in zip(heads[cuts[:-1]].tolist(), cuts, cuts[1:]):
                at[word] = self._put(at.get(word, {}), rest[lo:hi], counts[lo:hi])
            return at
        before = len(at)
        for key, n in zip(_keys(rows), counts.tolist()):
            at[key] = at.get(key, 0) + n
        self.entries += len(at) - before
        if len(at) <= self.burst or rows.shape[1] == 1:
            return at
        rows, counts = _sorted(_ids(at), np.fromiter(at.values(), np.int64, len(at)))
        self.entries -= len(at)
        return self._put(Node(), rows, counts)

    def spill(self, everything: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Subtrees as (sequences, counts), removed while they are handed out."""
        least = 0 if everything else self.most // 2
        if self.entries <= (0 if everything else self.most):
            return
        if isinstance(self.root, Node):
            for word in sorted(self.root, key=lambda word: _size(self.root[word]), reverse=True):
                if self.entries <= least:
                    return
                tree = self.root.pop(word)
                self.entries -= _size(tree)
                yield _flat(tree, (word,))
        else:
            tree, self.root, self.entries = self.root, {}, 0
            yield _flat(tree, ())


def phrase_counts(docs: DataFrame, text_column: str = "text", lang_column: str = "lang",
                  longest: int = LONGEST, least: int = LEAST, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words seen ``least`` times in their language, and words in all.

    The first table has ``lang``, ``phrase``, ``k`` (words), ``n`` (occurrences); the second
    ``lang``, ``total``. Lengths are counted in the order of ``steps``. A sequence is inserted only
    if all its parts of the length counted last may be frequent, as a filter of their hashes says;
    a false positive costs room, never a count. Each task's sorted runs meet by whole phrase: a
    common first word or pair of words thus makes no partition larger than others.

    The filter has ``BITS_EACH`` bits for each frequent phrase. Where that would pass
    ``max_bits``, the phrases are dealt by hash into several filters, and as many passes over the
    texts each take the sequences whose first part is in theirs.
    """
    texts = docs.select(
        F.coalesce(named(lang_column), F.lit(UNKNOWN)).alias("lang"),
        text_or_empty(named(text_column)).alias("text"))
    first = stored(_merged(_runs(texts, (1,))).where((F.col("n") >= least) | F.isnull("phrase")), "phrases")
    totals = first.where("phrase is null").select("lang", F.col("n").alias("total"))
    levels = [first.where(F.col("phrase").isNotNull() & (F.col("n") >= least)).withColumn("k", F.lit(1))]
    words, last = None, levels[0]
    for sizes, part_size in zip(steps(longest)[1:], steps(longest)):
        known = last.count()
        if not known:
            break
        passes = -(-known * BITS_EACH // max_bits)
        bits = min(max_bits, 1 << max(known * BITS_EACH // passes, 64).bit_length())
        parts = []
        for n in range(passes):
            table = _filter(last, bits, n, passes)
            words = table if sizes == (2,) and passes == 1 else words
            parts.append(_runs(texts, sizes, part_size[-1], table, n, passes, words))
        counted = _merged(reduce(DataFrame.union, parts)).where(F.col("n") >= least)
        levels.append(stored(counted.withColumn("k", F.size(F.split("phrase", " "))), "phrases"))
        last = levels[-1].where(F.col("k") == sizes[-1])
    return reduce(DataFrame.union, levels).select("lang", "phrase", "k", "n"), totals


def steps(longest: int) -> list[tuple[int, ...]]:
    """Lengths counted in one pass: 1, 2 and 3 alone, then two at a time."""
    return [(k,) for k in range(1, min(longest, 3) + 1)] + [
        tuple(range(k, min(k + 2, longest + 1))) for k in range(4, longest + 1, 2)]


def collocations(docs: DataFrame, text_column: str = "text", lang_column: str = "lang",
                 longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP,
                 max_bits: int = MAX_BITS) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's best.

    A-Z are lower-cased, texts cut into pieces and those into words; a phrase is a run of 2 to
    ``longest`` words of a piece, seen ``a >= least`` times. Cut after its first words it has
    parts seen ``l`` and ``r`` times, among ``n`` words in all; of the scores
    floor(1000 a n / (l r)) the lowest counts, ties to the shortest first part. Phrases inside
    a longer one that has ``share`` hundredths of their occurrences go. Whole numbers of 38 digits
    keep the arithmetic exact. Ties of scores: more occurrences, then the phrase in byte order.

    Null and empty texts have no word, null languages are ``und``, repeated rows count again,
    other columns have no say. No text gives no row.
    """
    counts, totals = phrase_counts(docs, text_column, lang_column, longest, least, max_bits)
    phrases = counts.where("k > 1")
    parts = F.split("phrase", " ", -1)

    def words(start: Column, length: Column) -> Column:
        return F.array_join(F.slice(parts, start, length), " ")

    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), "k", F.explode(
        F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("*", words(F.lit(1), F.col("cut")).alias("head"),
                       words(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    whole = {name: F.col(name).cast("decimal(38,0)") for name in ("a", "l", "r", "total")}
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(totals, "lang")
    scored = scored.withColumns({"above": 1000 * whole["a"] * whole["total"], "below": whole["l"] * whole["r"]})
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct(
        F.expr("above div below").alias("score"), "cut", "a", "l", "r", F.col("total").alias("n"))).alias("x"))

    inner = phrases.where("k > 2").select("lang", "n", "k", "phrase", F.explode(
        F.sequence(F.lit(2), F.col("k") - 1)).alias("size")).select("*", F.explode(
            F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start"))
    inside = inner.select("lang", words(F.col("start"), F.col("size")).alias("phrase"), "n").groupBy(
        "lang", "phrase").agg(F.max("n").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").where(
        F.isnull("longer") | (100 * F.col("longer") < share * F.col("x.a")))
    order = Window.partitionBy("lang").orderBy(F.desc("x.score"), F.desc("x.a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")


def tokens(text: bytes) -> list[bytes]:
    """Words in order, ``.`` between pieces; words never hold that."""
    return text.translate(_TABLE).replace(b".", b" . ").split()


def _merged(runs: DataFrame) -> DataFrame:
    return runs.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _runs(texts: DataFrame, sizes: tuple[int, ...], part_size: int = 0, known=None, part: int = 0,
          passes: int = 1, words=None) -> DataFrame:
    """Each task's counts of sequences, as sorted runs; with size 1 also its words in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(sizes, part_size, known and known.value, part, passes, words and words.value)
        for batch in batches:
            langs, bodies = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for name, body in zip(langs, bodies):
                yield from counter.read(name, body)
        yield from counter.end()

    return texts.mapInArrow(run, _RUNS)


def _filter(phrases: DataFrame, bits: int, part: int, passes: int):
    """One bit for the hash of each phrase that falls to this pass, for all tasks."""
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, names = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            hashed = np.array([_phrase_hash(x, y) for x, y in zip(langs, names)], np.uint64)
            own = hashed[hashed % np.uint64(passes) == part] // np.uint64(passes) % np.uint64(bits)
            slots = (own >> np.uint64(6)).astype(np.int64)
            masks = (np.uint64(1) << (own & np.uint64(63))).view(np.int64)
            yield pa.record_batch([pa.array(slots), pa.array(masks)], names=["slot", "mask"])

    found = phrases.select("lang", "phrase").mapInArrow(marks, "slot long, mask long").groupBy(
        "slot").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most bits / 64 rows
    table = np.zeros(bits // 64, np.uint64)
    table[found.column("slot").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(table)


class _Words(dict):
    """Ids of a language's words; 0 for what cannot be part of a frequent phrase."""

    def __init__(self, counter: "_Counter", lang: str):
        super().__init__({b".": 0})
        self.counter, self.lang, self.seed = counter, lang, xxhash.xxh32_intdigest(lang)

    def __missing__(self, word: bytes) -> int:
        own = self.counter
        hashed = xxhash.xxh64_intdigest(word, self.seed)
        if own.words is not None:
            place = hashed % (8 * len(own.words))
            if not own.words[place >> 3] >> (place & 7) & 1:
                self[word] = 0
                return 0
        self[word] = at = len(own.names)
        own.names.append(word)
        own.langs.append(self.lang)
        own.hashes.append(hashed)
        return at


class _Counter:
    """Reads the texts of one task into tries, one for each size."""

    def __init__(self, sizes: tuple[int, ...], part_size: int, known: np.ndarray | None, part: int,
                 passes: int, words: np.ndarray | None):
        self.part_size, self.known, self.part, self.passes = part_size, known, part, passes
        self.words = None if words is None else words.tobytes()
        self.tries = {size: HatTrie() for size in sizes}
        self.totals: dict[str, int] = defaultdict(int)
        self.waiting = array("i")
        self._renumber()

    def _renumber(self) -> None:
        """Word ids, from 1, differ between languages; 0 also stands between pieces."""
        self.ids: dict[str, _Words] = {}
        self.names, self.langs, self.hashes = [b"."], [""], [0]

    def read(self, lang: str, body: bytes) -> Iterator[pa.RecordBatch]:
        found = tokens(body)
        if lang not in self.ids:
            self.ids[lang] = _Words(self, lang)
        self.waiting.extend(map(self.ids[lang].__getitem__, found))
        self.waiting.append(0)
        if 1 in self.tries:
            self.totals[lang] += len(found) - found.count(b".")
        if len(self.waiting) >= TOKENS_AT_ONCE:
            yield from self._count()

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self._count()
        yield from self._written(everything=True)
        if self.totals:
            yield pa.record_batch([
                pa.array(self.totals, pa.string()), pa.nulls(len(self.totals), pa.string()),
                pa.array(self.totals.values(), pa.int64())], schema=_ARROW)

    def _count(self) -> Iterator[pa.RecordBatch]:
        ids, self.waiting = np.array(self.waiting, np.int64), array("i")
        hashes = np.array(self.hashes, np.uint64)
        for size, trie in self.tries.items():
            trie.add(*_distinct(self._sequences(ids, hashes, size)))
        yield from self._written()
        if sum(map(len, self.ids.values())) > MOST_WORDS:
            yield from self._written(everything=True)
            self._renumber()

    def _sequences(self, ids: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
        """Runs of ``size`` words whose parts may be frequent, one a row."""
        whole = ids[: max(len(ids) - size + 1, 0)] > 0
        for step in range(1, size):
            whole &= ids[step : step + len(whole)] > 0
        at = np.flatnonzero(whole)
        if size > 1:
            for start in range(size - self.part_size + 1):
                hashed = hashes[ids[at + start]]
                for step in range(start + 1, start + self.part_size):
                    hashed = _mixed(hashed, hashes[ids[at + step]])
                at = at[self._may_be(hashed, start > 0)]
        return ids[at[:, None] + np.arange(size)]

    def _may_be(self, hashed: np.ndarray, elsewhere: bool) -> np.ndarray:
        """What this pass's filter holds, and what falls to another pass if ``elsewhere``."""
        passes = np.uint64(self.passes)
        place = hashed // passes % np.uint64(64 * len(self.known))
        word = self.known[(place >> np.uint64(6)).astype(np.int64)]
        found = (word >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        if self.passes == 1:
            return found
        own = hashed % passes == self.part
        return found & own | ~own if elsewhere else found & own

    def _written(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        names = langs = None
        for trie in self.tries.values():
            held, n = [], 0
            for run in trie.spill(everything):
                if names is None:
                    names, langs = pa.array(self.names, pa.binary()), pa.array(self.langs, pa.string())
                held.append(run)
                n += len(run[0])
                if n >= ROWS_AT_ONCE:
                    yield _run(held, names, langs)
                    held, n = [], 0
            if held:
                yield _run(held, names, langs)


def _run(subtrees: list[tuple[np.ndarray, np.ndarray]], names: pa.Array, langs: pa.Array) -> pa.RecordBatch:
    """Whole subtrees, spelt out and sorted by phrase."""
    rows, counts = (np.concatenate(part) for part in zip(*subtrees))
    words = [names.take(pa.array(rows[:, i])) for i in range(rows.shape[1])]
    phrases = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary())).cast(pa.string())
    order = pc.sort_indices(phrases)
    columns = langs.take(pa.array(rows[:, 0])), phrases, pa.array(counts)
    return pa.record_batch([column.take(order) for column in columns], schema=_ARROW)


def _keys(rows: np.ndarray) -> list:
    if rows.shape[1] == 1:
        return rows[:, 0].tolist()
    return rows.view(f"V{4 * rows.shape[1]}").ravel().tolist()


def _ids(container: dict) -> np.ndarray:
    """The keys of a container as rows of ids."""
    if isinstance(next(iter(container)), int):
        return np.fromiter(container, np.int32, len(container))[:, None]
    return np.frombuffer(b"".join(container), np.int32).reshape(len(container), -1)


def _sorted(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(rows[:, 0], kind="stable")
    return rows[order], counts[order]


def _size(tree: dict) -> int:
    return sum(map(_size, tree.values())) if isinstance(tree, Node) else len(tree)


def _flat(tree: dict, prefix: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """All sequences of a subtree and their counts."""
    if isinstance(tree, Node):
        parts = [_flat(below, (*prefix, word)) for word, below in tree.items()]
        return np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
    rest = _ids(tree)
    rows = np.empty((len(rest), len(prefix) + rest.shape[1]), np.int32)
    rows[:, : len(prefix)], rows[:, len(prefix) :] = prefix, rest
    return rows, np.fromiter(tree.values(), np.int64, len(tree))


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = rows[:, 0]
    for step in range(1, rows.shape[1]):
        if step > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key << 32 | rows[:, step]
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return rows[first], counts


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang))


def _mixed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    out = one * np.uint64(0x9E3779B97F4A7C15) + two
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def _phrase_hash(lang: str, phrase: bytes) -> int:
    parts = np.array([_word_hash(lang, word) for word in phrase.split(b" ")], np.uint64)
    return int(reduce(_mixed, parts[1:, None], parts[:1])[0])

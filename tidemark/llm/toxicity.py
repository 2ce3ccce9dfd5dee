"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

The network starts from a bounded sample. Then every labelled text is learned from, in shards side by
side whose networks are averaged, and the thresholds are set on every labelled text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import named, stored, text_or_empty

#: Bounds of the sample that the network starts from: about so many labelled rows of each class.
TRAINING_ROWS = 2_500
TRAINING_BYTES = 1 << 26
#: About so many labelled rows are learned from one after the other, shards side by side.
SHARD_ROWS = 4_096
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 16, 16, (1, 2, 3), 12
PARTS = 9  # hashed parts of a word
EPOCHS, RATE, BATCH = 6, 0.08, 16
WORDS_CACHED = 200_000
BLOCK = 1 << 14  # words whose responses are held at once
#: Bits for each labelled id in the filter of texts, and the most there are: 64 MB to broadcast.
ID_BITS, MAX_BITS = 8, 1 << 29
#: Thresholds lie on a grid of so many steps a logit, within the limit.
GRID, LIMIT = 256, 64
#: Shards send their weights as whole numbers of this part, so that sums do not depend on their order.
UNIT = 1 << 30

_WORD = re.compile(r"\w+")
# Frequent words of the languages that thresholds are set for.
COMMON = (
    ("the", "of", "and", "to", "in", "is", "that", "it", "was", "for"),
    ("le", "la", "les", "des", "et", "un", "une", "que", "pour", "dans"),
    ("der", "die", "und", "das", "den", "von", "zu", "ist", "mit", "nicht"),
    ("el", "los", "las", "que", "y", "en", "por", "con", "una", "se"),
)
_LANGUAGES = {}
for _n, _words in enumerate(COMMON):
    for _w in _words:
        _LANGUAGES.setdefault(_w, []).append(_n)
_SHIFTS = [(w, j) for w in WIDTHS for j in range(w)]
_SPANS = [slice(i * FILTERS, (i + 1) * FILTERS) for i in range(len(WIDTHS))]


def word_parts(word: str) -> list[int]:
    """Buckets of the word, of its beginnings and of its end; absent parts are -1."""
    size = len(word)
    if word.isascii():  # a longer beginning goes on from the shorter one
        data = word.encode()
        found = [zlib.crc32(b"=" + data)]
        if size > 3:
            found.append(zlib.crc32(b"^" + data[:3]))
            for n in range(3, min(size - 1, 8)):
                found.append(zlib.crc32(data[n : n + 1], found[-1]))
            found.append(zlib.crc32(b"$" + data[-3:]))
        if size > 5:
            found.append(zlib.crc32(b"$" + data[-5:]))
    else:
        parts = [f"={word}"] + [f"^{word[:n]}" for n in range(3, 9) if size > n]
        parts += [f"${word[-n:]}" for n in (3, 5) if size > n]
        found = [zlib.crc32(p.encode()) for p in parts]
    found = [n % BUCKETS for n in found]
    return found + [-1] * (PARTS - len(found))


def parts_of(words: Sequence[str]) -> np.ndarray:
    """words x PARTS."""
    found = chain.from_iterable(map(word_parts, words))
    return np.fromiter(found, np.int64, len(words) * PARTS).reshape(-1, PARTS)


class Numbers(dict):
    """Numbers words as they come; ``new`` are those since it was last emptied."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n

    def of(self, words: Sequence[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def split_words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Network(NamedTuple):
    """``kernel`` maps a word vector to every filter at every place within its window."""
    table: np.ndarray  # BUCKETS + 1 x DIM; the last row stands for absent parts
    kernel: np.ndarray  # DIM x places x FILTERS
    bias: np.ndarray
    out: np.ndarray
    base: float
    cuts: np.ndarray  # logit above which a text counts as toxic, per language and in general
    sums: tuple = ()  # of squared slopes, for each of the weights above; none in a silent network


def vectors(table: np.ndarray, parts: np.ndarray) -> np.ndarray:
    total = table[parts[:, 0]]
    for part in parts.T[1:]:
        total += table[part]
    return total / np.sqrt((parts >= 0).sum(axis=1, keepdims=True), dtype=np.float32)


def pooled(seen: np.ndarray, places: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Largest response and its place for every filter; ``seen`` is words x places x FILTERS.

    Without ``places`` these are left at 0. A text shorter than a window has one all the same: each of its words at every place, summed.
    """
    n = len(seen)
    most, where = np.empty(len(WIDTHS) * FILTERS, np.float32), np.zeros(len(WIDTHS) * FILTERS, np.int64)
    place = 0
    for width, span in zip(WIDTHS, _SPANS):
        if n < width:
            most[span] = seen[:, place : place + width].sum(axis=(0, 1)) if n else 0
        else:
            total = seen[: n - width + 1, place].copy() if width > 1 else seen[:, place]
            for j in range(1, width):
                total += seen[j : n - width + 1 + j, place + j]
            if places:
                where[span] = total.argmax(axis=0)
            most[span] = total.max(axis=0)
        place += width
    return most, where


def pooled_blocks(response: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``pooled`` of ``response[at]``, a block of words at a time."""
    most, where = pooled(response[at[:BLOCK]])
    for start in range(BLOCK, len(at), BLOCK):
        first = start - max(WIDTHS) + 1
        more, there = pooled(response[at[first : start + BLOCK]])
        where = np.where(more > most, there + first, where)
        most = np.maximum(most, more)
    return most, where


def language(votes: np.ndarray) -> int:
    """The language whose frequent words are most; the last number if there are none."""
    return int(votes.argmax()) if votes.any() else len(COMMON)


def word_votes(words: Sequence[str]) -> np.ndarray:
    """words x languages: 1 where the word is a frequent one."""
    votes = np.zeros((len(words), len(COMMON)), np.float32)
    for n, word in enumerate(words):
        if word in _LANGUAGES:
            votes[n, _LANGUAGES[word]] = 1
    return votes


class Scorer:
    """Scores texts with one network. Responses of words are kept, a bounded number of them."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.kernel = net.kernel.reshape(DIM, -1)
        self._forget()

    def _forget(self) -> None:
        self.rows = Numbers()
        self.seen = np.zeros((0, len(_SHIFTS), FILTERS), np.float32)
        self.votes = np.zeros((0, len(COMMON)), np.float32)

    def logit(self, text: str | None) -> float:
        """Above 0 if the text passes the threshold of its language. Any length of text."""
        value, spoken = self.heard(text)
        return float(value - self.net.cuts[spoken])

    def heard(self, text: str | None) -> tuple[float, int]:
        """The logit before thresholds, and the language."""
        words = split_words(text)
        most = np.full(len(WIDTHS) * FILTERS, -np.inf, np.float32)
        votes = np.zeros(len(COMMON))
        overlap = max(WIDTHS) - 1
        for start in range(0, max(len(words), 1), BLOCK):  # bounds the memory of very long texts
            at = self._rows(words[max(start - overlap, 0) : start + BLOCK])
            most = np.maximum(most, pooled(self.seen[at], places=False)[0])
            votes += self.votes[at].sum(axis=0)
        hidden = np.maximum(most + self.net.bias, 0)
        return float(hidden @ self.net.out + self.net.base), language(votes)

    def _rows(self, words: list[str]) -> np.ndarray:
        if len(self.rows) > WORDS_CACHED:
            self._forget()
        at = self.rows.of(words)
        new = self.rows.new
        if new:
            found = vectors(self.net.table, parts_of(new)) @ self.kernel
            size = len(self.rows)
            if size > len(self.seen):
                grown = np.zeros((max(2 * len(self.seen), size, 4096), *self.seen.shape[1:]), np.float32)
                grown[: len(self.seen)] = self.seen
                more = np.zeros((len(grown), len(COMMON)), np.float32)
                more[: len(self.votes)] = self.votes
                self.seen, self.votes = grown, more
            self.seen[size - len(new) : size] = found.reshape(-1, len(_SHIFTS), FILTERS)
            self.votes[size - len(new) : size] = word_votes(new)
            new.clear()
        return at


def summed(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """size x DIM: sums of the rows of ``values`` by their place."""
    flat = (at[:, None] * DIM + np.arange(DIM)).ravel()
    return np.bincount(flat, values.ravel(), size * DIM).reshape(size, DIM)


def untrained(rng: np.random.Generator, base: float) -> Network:
    wide = len(WIDTHS) * FILTERS
    table = rng.normal(0, 0.1, (BUCKETS + 1, DIM)).astype(np.float32)
    table[-1] = 0
    kernel = rng.normal(0, 0.3, (DIM, len(_SHIFTS), FILTERS)).astype(np.float32)
    bias, out = np.zeros(wide, np.float32), rng.normal(0, 0.3, wide).astype(np.float32)
    sums = (*(np.full_like(a, 1e-2) for a in (table, kernel, bias, out)), 1e-2)
    return Network(table, kernel, bias, out, base, np.zeros(len(COMMON) + 1), sums)


def silent(net: Network) -> Network:
    """Every text gets ``net.base``."""
    return net._replace(out=0 * net.out, sums=())


def log_odds(share: float) -> float:
    return float(np.log(share / (1 - share)))


class Learner:
    """Stochastic gradient descent (Adagrad) on logistic loss, from a copy of ``net``."""

    def __init__(self, net: Network, rng: np.random.Generator) -> None:
        self.table, self.kernel, self.bias, self.out = (a.copy() for a in net[:4])
        self.base, self.rng = net.base, rng
        *sums, self.sum_base = net.sums
        self.sums = [a.copy() for a in sums]
        self.moved = np.zeros(len(self.table), bool)
        self.words = Numbers()
        self.parts = np.zeros((0, PARTS), np.int64)

    def network(self) -> Network:
        return Network(self.table, self.kernel, self.bias, self.out, self.base,
                       np.zeros(len(COMMON) + 1), (*self.sums, self.sum_base))

    def texts(self, texts: Sequence[str | None], y: Sequence[float]) -> None:
        """Learns from a few texts once. Parts of words are kept, a bounded number of them."""
        if len(self.words) > WORDS_CACHED:
            self.words = Numbers()
        docs, new = [self.words.of(split_words(t)) for t in texts], self.words.new
        if len(self.words) > len(self.parts):
            grown = np.full((max(2 * len(self.parts), len(self.words)), PARTS), -1)
            grown[: len(self.parts)] = self.parts
            self.parts = grown
        if new:
            self.parts[len(self.words) - len(new) : len(self.words)] = parts_of(new)
            new.clear()
        self.step(docs, y, self.parts)

    def step(self, docs: Sequence[np.ndarray], y: Sequence[float], parts: np.ndarray) -> None:
        """One step from a few texts, each the numbers of its words in ``parts``."""
        rng, table, kernel, bias, out = self.rng, self.table, self.kernel, self.bias, self.out
        # Half of the texts lose half of their words, so that no word can rely on the others.
        some = [d[rng.random(len(d)) < 0.5] if rng.random() < 0.5 else d for d in docs]
        used, inverse = np.unique(np.concatenate(some), return_inverse=True)
        known = parts[used]
        vector = vectors(table, known)
        response = (vector @ kernel.reshape(DIM, -1)).reshape(-1, len(_SHIFTS), FILTERS)
        d_kernel, d_bias, d_out, d_base = np.zeros_like(kernel), np.zeros_like(bias), np.zeros_like(out), 0.0
        words, steps = [np.zeros(0, np.int64)], [np.zeros((0, DIM), np.float32)]
        begin = 0
        for label, doc in zip(y, some):
            at = inverse[begin : begin + len(doc)]
            begin += len(at)
            most, where = pooled_blocks(response, at)
            hidden = np.maximum(most + bias, 0)
            error = float(1 / (1 + np.exp(-(hidden @ out + self.base))) - label)
            d_out += error * hidden
            d_base += error
            d_hidden = error * out * (hidden > 0)
            d_bias += d_hidden
            for place, (width, j) in enumerate(_SHIFTS):
                if len(at) < width:
                    continue
                span = _SPANS[WIDTHS.index(width)]
                word = at[where[span] + j]
                d_kernel[:, place] += vector[word].T * d_hidden[span]
                words.append(word)
                steps.append((kernel[:, place] * d_hidden[span]).T)
        d_vector = summed(np.concatenate(words), np.concatenate(steps), len(used))
        moved = np.flatnonzero(d_vector.any(axis=1))
        step = d_vector[moved] / np.sqrt((known[moved] >= 0).sum(axis=1, keepdims=True))
        spots = known[moved]
        d_table = np.repeat(step[:, None], PARTS, axis=1)[spots >= 0]
        rows, place = np.unique(spots[spots >= 0], return_inverse=True)
        self.sums[0][rows] += summed(place, d_table**2, len(rows))
        table[rows] -= RATE * summed(place, d_table, len(rows)) / np.sqrt(self.sums[0][rows])
        self.moved[rows] = True
        for value, slope, total in zip((kernel, bias, out), (d_kernel, d_bias, d_out), self.sums[1:]):
            total += slope**2
            value -= RATE * slope / np.sqrt(total)
        self.sum_base += d_base**2
        self.base -= RATE * d_base / np.sqrt(self.sum_base)


def train(texts: Sequence[str], labels: Sequence[int], share: float | None = None,
          epochs: int = EPOCHS, seed: int = 7) -> Network:
    """A network from texts that fit into memory; a fifth of them sets its thresholds.

    ``share`` is the part of toxic texts in the whole; the sample may hold more of them. Without
    labels of both kinds the network is silent and every score equals the smoothed share.
    """
    rng = np.random.default_rng(seed)
    y = np.array(labels, float)
    level = (y.sum() + 1) / (len(y) + 2)
    start = untrained(rng, log_odds(level))
    if len(set(y.tolist())) < 2:
        return silent(start)
    vocabulary = Numbers()
    docs = [vocabulary.of(split_words(t)) for t in texts]
    parts = parts_of(list(vocabulary))
    votes = word_votes(list(vocabulary))
    rows = rng.permutation(len(docs))
    held, seen = rows[: len(rows) // 5], rows[len(rows) // 5 :]
    learner = Learner(start, rng)
    for _ in range(epochs):
        for begin in range(0, len(seen), BATCH):
            batch = rng.permutation(seen)[:BATCH] if begin + BATCH > len(seen) else seen[begin : begin + BATCH]
            learner.step([docs[i] for i in batch], y[batch], parts)
        rng.shuffle(seen)
    net = learner.network()
    scorer = Scorer(net)
    logits = np.array([scorer.logit(texts[i]) for i in held])
    spoken = np.array([language(votes[docs[i]].sum(axis=0)) for i in held])
    return net._replace(cuts=thresholds(logits, y[held], spoken, share if share is not None else level, level))


def thresholds(logits: np.ndarray, y: np.ndarray, spoken: np.ndarray, share: float, level: float,
               often: np.ndarray | None = None) -> np.ndarray:
    """Per language, the logit that makes the fewest (weighted) mistakes.

    Rows are weighted back to the share of toxic texts in the whole; each stands for ``often`` texts.
    Fewer than 3 toxic or other texts of a language set none: it uses the threshold of all together.
    """
    often = np.ones(len(y)) if often is None else often
    weight = often * np.where(y == 1, share / level, (1 - share) / (1 - level))

    def cut(of: np.ndarray) -> float:
        value, place = np.unique(logits[of], return_inverse=True)
        missed = np.r_[0, np.cumsum(np.bincount(place, (weight * y)[of]))]
        false = np.r_[np.cumsum(np.bincount(place, (weight * (1 - y))[of])[::-1])[::-1], 0]
        best = np.flatnonzero(missed + false <= (missed + false).min() + 1e-9)
        middle = best[len(best) // 2]
        padded = np.r_[value[0] - 1, value, value[-1] + 1]
        return float((padded[middle] + padded[middle + 1]) / 2)

    general = cut(np.ones(len(y), bool)) if 0 < y.sum() < len(y) else 0.0
    found = [
        cut(spoken == n) if min((often * y)[spoken == n].sum(), (often * (1 - y))[spoken == n].sum()) >= 3 else general
        for n in range(len(COMMON))
    ]
    return np.array([*found, general])


def perhaps_labelled(texts: DataFrame, known: DataFrame, rows: int) -> DataFrame:
    """All texts of ``known`` ids and a few others: a bitmap of hashes spares the rest a shuffle."""
    spot = F.pmod(F.xxhash64("id"), F.lit(min(rows * ID_BITS, MAX_BITS))) + 1
    bits = known.groupBy(F.bitmap_bucket_number(spot).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits"))
    place = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return texts.withColumn("part", F.bitmap_bucket_number(spot)).join(F.broadcast(bits), "part").where(
        F.getbit(byte, (place % 8).cast("int")) == 1).select("id", "text")


def weights(learner: Learner) -> pd.DataFrame:
    """``place``, ``v0`` and on: all rows of the table that moved, then the other weights in rows of DIM."""
    rest = np.r_[learner.kernel.ravel(), learner.bias, learner.out, learner.base]
    rest = np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)
    rows = np.flatnonzero(learner.moved)
    places = np.r_[rows, len(learner.table) + np.arange(len(rest))]
    values = np.rint(np.concatenate([learner.table[rows], rest]).astype(float) * UNIT).astype(np.int64)
    return pd.DataFrame({"place": places, **{f"v{n}": values[:, n] for n in range(DIM)}})


def averaged(net: Network, places: np.ndarray, values: np.ndarray) -> Network:
    """``net`` with the weights at ``places``; rows of the table that no shard moved stay."""
    table = net.table.copy()
    words = places < len(table)
    table[places[words]] = values[words]
    rest = values[~words][np.argsort(places[~words])].ravel()
    kernel, bias, out, base = np.split(rest, np.cumsum([net.kernel.size, net.bias.size, net.out.size]))
    return Network(table, kernel.reshape(net.kernel.shape).astype(np.float32), bias.astype(np.float32),
                   out.astype(np.float32), float(base[0]), net.cuts)


def learned(net: Network, texts: DataFrame, known: DataFrame, rows: int) -> Network:
    """``net`` after the texts of all ``rows`` ids of ``known``: the mean of what shards of them make of it.

    Shards are told by a hash of the id, so they do not depend on how the table is stored. A row of
    the table is averaged over the shards that moved it, lest words of few shards fade. What reaches
    the driver is one set of weights, whatever the number of shards.
    """
    start = known.sparkSession.sparkContext.broadcast(net)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learner, held = Learner(start.value, np.random.default_rng(7)), None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            whole = len(held) // BATCH * BATCH
            for n in range(0, whole, BATCH):
                part = held.iloc[n : n + BATCH]
                learner.texts(part["text"].tolist(), part["label"].tolist())
            held = held.iloc[whole:]
        if held is not None and len(held):
            learner.texts(held["text"].tolist(), held["label"].tolist())
        if held is not None:
            yield weights(learner)

    columns = [f"v{n}" for n in range(DIM)]
    parts = -(-rows // SHARD_ROWS)
    found = perhaps_labelled(texts, known, rows).repartition(parts, "id").join(known.repartition(parts, "id"), "id")
    shards = found.groupBy("id", "label").agg(F.max("text").alias("text")).sortWithinPartitions(
        F.xxhash64("id", F.lit(7)), "id")
    moved = shards.select("label", "text").mapInPandas(
        each, ", ".join(["place long", *(f"{c} long" for c in columns)]))
    mean = moved.groupBy("place").agg(*[(F.sum(c) / F.count(c) / UNIT).alias(c) for c in columns]).toArrow()
    if not len(mean):
        return net
    values = np.stack([mean[c].to_numpy() for c in columns], axis=1)
    return averaged(net, mean["place"].to_numpy(), values)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
                    text_column: str = "text", label: str = "toxic",
                    training: int = TRAINING_ROWS, training_bytes: int = TRAINING_BYTES,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Every row as the struct ``row`` of ``columns`` (all), with ``score`` from 0 to 1.

    0.5 is the threshold of the text's own language, which is told by its frequent words.
    ``labels`` holds doc_id and the label (of several the largest counts, null ones do not).
    Null and empty texts are scored like any other; rows with a null id are never learned from.
    Every labelled text is learned from and counts for the thresholds, whole and whatever its length,
    null ones as empty; of several texts under one id the largest is learned from. The network starts
    on the driver, from a sample whose size does not depend on the input: of each
    label about ``training`` documents, in the order of a hash of their ids, up to ``training_bytes``
    of text for both labels together. Without labels of both kinds every score is the smoothed share.
    """
    texts = docs.select(named(id_column).alias("id"), text_or_empty(named(text_column)).alias("text"))
    known = stored(labels.select(named("doc_id").alias("id"), named(label).alias("label")).where(
        "label IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.max("label").alias("label")).join(
        texts.select("id"), "id", "left_semi"), "toxicity-known")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    limit = F.lit(0)
    for value, count in counts.items():
        limit = F.when(F.col("label") == value, int((1 << 20) * min(1, training / count))).otherwise(limit)
    chosen = stored(known.where(place < limit).coalesce(1), "toxicity-labels")  # bounded by ``training``
    sample = stored(texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(
        F.max("text").alias("text")), "toxicity-sample")
    upto = F.sum(F.octet_length("text")).over(Window.partitionBy("label").orderBy(place, "id"))
    rows = sorted(sample.withColumn("upto", upto).where(
        F.col("upto") <= training_bytes // 2).select("id", "label", "text").collect())
    total, toxic = sum(counts.values()), counts.get(1, 0)
    net = train([r["text"] for r in rows], [r["label"] for r in rows], toxic / max(total, 1))
    level = (toxic + 1) / (total + 2)
    if 0 < toxic < total:
        start = net if net.sums else untrained(np.random.default_rng(7), log_odds(level))
        net = learned(start, texts, known, total)
    else:
        net = silent(net)._replace(base=log_odds(level))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def hear(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.DataFrame([scorer.heard(t) for t in texts], columns=["logit", "spoken"])

    heard = stored(docs.select(
        F.struct(*[named(c) for c in columns or docs.columns]).alias("row"), named(id_column).alias("id"),
        F.pandas_udf(hear, "logit double, spoken int")(named(text_column)).alias("heard"),
    ).select("row", "id", "heard.*"), "toxicity-logits")
    cuts = net.cuts
    if net.out.any():
        step = F.floor(F.least(F.greatest("logit", F.lit(-LIMIT)), F.lit(LIMIT)) * GRID).alias("step")
        cells = heard.select("id", "spoken", step).join(known, "id").groupBy("spoken", "step", "label").count().toArrow()
        spoken, steps, y, often = (cells[c].to_numpy() for c in ("spoken", "step", "label", "count"))
        cuts = thresholds((steps + 0.5) / GRID, y == 1, spoken, level, level, often)
    logit = F.col("logit") - F.get(F.array(*map(F.lit, cuts.tolist())), F.col("spoken"))
    return heard.select("row", (1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30)), F.lit(30))))).alias("score"))

"""Byte-pair encoding with forced boundaries, and decoding."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT = 60_000  # chunks a worker keeps the ids of; then it starts anew
LONGEST_KEPT = 64
AT_ONCE = 20_000  # chunks encoded together
CHARS_AT_ONCE = 1 << 20
LONG = 256  # bytes of a fragment that is merged by a heap
PAIR = 24  # bits of an id within the key of a pair

# The published pattern of byte-level tokenizers, and Unicode's white space.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself where printable."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoder:
    """Encodes with one vocabulary file.

    A pair of neighbouring bytes that no token of the vocabulary contains can lie in no
    token of an encoding, so every such pair is a certain cut: what stands on its two sides is
    encoded independently and the ids are concatenated. Between texts the same fragments
    return, and their ids are kept.

    Cuts between anything else and white space come first, found on the text itself; they
    hold for the pre-tokenizing pattern too, as it never lets white space follow anything else
    within a piece, and looks ahead from white space only. The other cuts are made inside the
    pattern's pieces, whose look-ahead they could otherwise change.
    """

    def __init__(self, spec: str) -> None:
        data = json.loads(spec)
        letters = byte_letters()
        as_bytes = lambda token: bytes(map(letters.__getitem__, token))
        model = data["model"]
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.ids = {as_bytes(t): n for t, n in model["vocab"].items() if t not in self.added}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = [(as_bytes(a), as_bytes(b)) for a, b in merges]
        self.ranks = {self.ids[a] << PAIR | self.ids[b]: n for n, (a, b) in enumerate(pairs)}
        self.results = np.array([self.ids[a + b] for a, b in pairs])
        self.single = np.array([self.ids[bytes([b])] for b in range(256)])
        # The same ranks to look up for many pairs at once.
        self.keys = np.array(sorted(self.ranks))
        self.sorted_ranks = np.array([self.ranks[key] for key in self.keys.tolist()])
        self.inside = np.zeros((256, 256), bool)
        for token in self.ids:
            code = np.frombuffer(token, np.uint8)
            self.inside[code[:-1], code[1:]] = True
        # Cuts before white space, unless some token has white space after another ASCII byte.
        white = np.frombuffer(b"\t\n\x0b\x0c\r ", np.uint8)
        certain = not self.inside[np.ix_(np.setdiff1d(np.arange(128), white), white)].any()
        self.chunks = re.compile(
            f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+" if certain else "(?s:.+)").findall
        self.pieces = regex.compile(PATTERN).findall
        self.special = re.compile("|".join(map(re.escape, self.added))) if self.added else None
        self.kept: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; some millions of characters at a time bound the memory."""
        found: list[np.ndarray] = []
        start = size = 0
        for end, text in enumerate(texts, 1):
            size += len(text)
            if size >= CHARS_AT_ONCE or end == len(texts):
                found += self._encode(texts[start:end])
                start, size = end, 0
        return found

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        """Chunks that are not known yet are encoded together."""
        if len(self.kept) > KEPT:
            self.kept.clear()
        parts = [self._parts(text) for text in texts]
        kept = self.kept
        new = list(dict.fromkeys(chunk for chunks in parts for chunk in chunks if chunk not in kept))
        for start in range(0, len(new), AT_ONCE):
            self._learn(new[start : start + AT_ONCE])
        found = [np.frombuffer(b"".join(map(kept.__getitem__, c)), np.int32) for c in parts]
        for chunk in new:
            if len(chunk) > LONGEST_KEPT:
                del kept[chunk]
        return found

    def _parts(self, text: str) -> list[str]:
        """Chunks, and added tokens as chunks of their own."""
        if self.special is None or not self.special.search(text):
            return self.chunks(text)
        found, start = [], 0
        for match in self.special.finditer(text):
            found += [*self.chunks(text[start : match.start()]), match[0]]
            start = match.end()
        return found + self.chunks(text[start:])

    def _learn(self, chunks: list[str]) -> None:
        pieces: list[bytes] = []
        first = []
        for chunk in chunks:
            first.append(len(pieces))
            # A word of letters, with or without a space before it, is one piece of the pattern.
            word = chunk[1:] if chunk[0] == " " else chunk
            if word.isalpha():
                pieces.append(chunk.encode())
            else:
                pieces += map(str.encode, self.pieces(chunk))
        ids, owner = self.merged(pieces)
        ends = np.searchsorted(owner, [*first, len(pieces)]) * 4
        packed = ids.astype(np.int32).tobytes()
        for chunk, start, end in zip(chunks, ends[:-1].tolist(), ends[1:].tolist()):
            self.kept[chunk] = packed[start:end]
        for token in self.added.keys() & set(chunks):
            self.kept[token] = np.int32(self.added[token]).tobytes()

    def fragments(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and where a fragment starts: with a piece, and at every forced cut."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.zeros(len(data), bool)
        starts[np.cumsum([0, *map(len, pieces[:-1])])] = True
        starts[1:] |= ~self.inside[data[:-1], data[1:]]
        return data, starts

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order, and the number of the piece that each belongs to.

        In every fragment the pair of the lowest rank is merged, the leftmost first, until no
        pair has a rank; a round takes one pair of every fragment.
        """
        data, starts = self.fragments(pieces)
        piece = np.repeat(np.arange(len(pieces)), list(map(len, pieces)))
        owner = np.cumsum(starts) - 1  # fragments
        of_piece = piece[starts]
        symbols, none = self.single[data], len(self.results)
        done_symbols, done_owner = [], []
        sizes = np.bincount(owner)
        for long in np.flatnonzero(sizes > LONG):
            found = self._merged_long(symbols[owner == long].tolist())
            done_symbols.append(np.array(found))
            done_owner.append(np.full(len(found), long))
        short = (sizes <= LONG)[owner]
        symbols, owner = symbols[short], owner[short]
        ranks = self._ranks(symbols, owner, np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[first, len(owner)])
            least = np.repeat(np.minimum.reduceat(ranks, first), sizes)
            going = least < none
            if not going.all():
                done_symbols.append(symbols[~going])
                done_owner.append(owner[~going])
                symbols, owner, ranks, least = symbols[going], owner[going], ranks[going], least[going]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == least)
            at = at[np.r_[True, owner[at[1:]] != owner[at[:-1]]]]
            symbols[at] = self.results[ranks[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, owner, ranks = symbols[stays], owner[stays], ranks[stays]
            at -= np.arange(len(at))
            ranks[at] = self._ranks(symbols, owner, at)
            before = at[at > 0] - 1
            ranks[before] = self._ranks(symbols, owner, before)
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return symbols[order], of_piece[owner[order]]

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of each symbol with the next of its fragment; the number of ranks if none."""
        found = np.full(len(at), len(self.results))
        inner = np.flatnonzero(at + 1 < len(symbols))
        inner = inner[owner[at[inner]] == owner[at[inner] + 1]]
        keys = symbols[at[inner]] << PAIR | symbols[at[inner] + 1]
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[place] == keys
        found[inner[known]] = self.sorted_ranks[place[known]]
        return found

    def _merged_long(self, parts: list[int]) -> list[int]:
        """The same by a heap: n log n, for words without end."""
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap: list[tuple[int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] >= 0:
                pair = parts[at] << PAIR | parts[after[at]]
                if (rank := self.ranks.get(pair)) is not None:
                    heapq.heappush(heap, (rank, at, pair))

        for at in range(len(parts) - 1):
            offer(at)
        while heap:
            rank, at, pair = heapq.heappop(heap)
            then = after[at]
            if then < 0 or parts[at] << PAIR | parts[then] != pair:
                continue
            parts[at], parts[then] = int(self.results[rank]), -1
            after[at], after[then] = after[then], -1
            if after[at] >= 0:
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [part for part in parts if part >= 0]


class Decoder:
    """The bytes of every id of a vocabulary file."""

    def __init__(self, spec: str) -> None:
        data, letters = json.loads(spec), byte_letters()
        self.tokens = {
            n: bytes(map(letters.__getitem__, token)) for token, n in data["model"]["vocab"].items()
            if all(c in letters for c in token)
        } | {t["id"]: t["content"].encode() for t in data["added_tokens"]}

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _decoder(spec: str) -> Decoder:
    return Decoder(spec)


@lru_cache(maxsize=2)
def _encoder(spec: str) -> Encoder:
    return Encoder(spec)


def bpe_encode(docs: DataFrame, vocabulary: str, text_column: str = "text",
               ids_column: str = "ids") -> DataFrame:
    """``docs`` with the ids of the whole text; a null text counts as empty and has none.

    ``vocabulary`` is the path of a tokenizer file on the driver (a few MB, the bound of the
    broadcast). Added tokens in a text get their own ids. An id column of that name is replaced.
    """
    shared = _shared(docs, vocabulary)

    def encode(texts: pa.Array) -> pa.Array:
        encoder = _encoder(shared.value)
        found = encoder.encode([text or "" for text in texts.to_pylist()])
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        ids = np.concatenate(found) if found else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))

    # Declared so, Spark keeps it in a step of its own, where it runs once however often the
    # ids are used.
    coded = F.arrow_udf(encode, "array<int>").asNondeterministic()
    return docs.withColumn(ids_column, coded(F.col(text_column)))


def bpe_decode(docs: DataFrame, vocabulary: str, ids_column: str = "ids",
               decoded_column: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids stand for; null ids give an empty text."""
    shared = _shared(docs, vocabulary)

    def decode(ids: pa.Array) -> pa.Array:
        return pa.array(map(_decoder(shared.value).decode, _lists(ids)), pa.string())

    return docs.withColumn(decoded_column, F.arrow_udf(decode, "string")(F.col(ids_column)))


def bpe_round_trip(docs: DataFrame, vocabulary: str, text_column: str = "text",
                   column: str = "coded") -> DataFrame:
    """``docs`` with ``ids``, packed as little-endian 32-bit integers, and the ``decoded`` text.

    Both in one struct from one Python worker, so a text crosses to it and is encoded once.
    """
    shared = _shared(docs, vocabulary)

    def both(texts: pa.Array) -> pa.Array:
        encoder, decoder = _encoder(shared.value), _decoder(shared.value)
        found = encoder.encode([text or "" for text in texts.to_pylist()])
        packed = pa.array((n.astype("<u4").tobytes() for n in found), pa.binary())
        return pa.StructArray.from_arrays(
            [packed, pa.array(map(decoder.decode, found), pa.string())], ["ids", "decoded"])

    coded = F.arrow_udf(both, "struct<ids:binary,decoded:string>").asNondeterministic()
    return docs.withColumn(column, coded(F.col(text_column)))


def _lists(ids: pa.Array) -> Iterator[np.ndarray]:
    """The ids of every row; none for null."""
    values, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
    for valid, start, end in zip(ids.is_valid().to_pylist(), ends[:-1], ends[1:]):
        yield values[start:end] if valid else values[:0]


def _shared(docs: DataFrame, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())

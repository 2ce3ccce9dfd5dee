"""Phrase counts against plain counting, with containers and filters far too small."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, empty

from tidemark.llm import collocations as module
from tidemark.llm.collocations import HatTrie, collocations, phrase_counts

CUT = re.compile(r"[.,;:!?\x0A-\x0D]")


def pieces(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", piece) if w] for piece in CUT.split(lower)]


def counted(docs, longest=5):
    out, totals = Counter(), Counter()
    for lang, text in docs:
        for words in pieces(text):
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    out[lang or "und", k, " ".join(words[i : i + k])] += 1
    return out, totals


def expected(docs, least, top):
    counts, totals = counted(docs)
    counts = {key: n for key, n in counts.items() if n >= least}
    rows = []
    for (lang, k, phrase), a in counts.items():
        words = phrase.split(" ")
        longer = [
            n for (other, size, x), n in counts.items() if other == lang and size > k
            and any(x.split(" ")[i : i + k] == words for i in range(size - k + 1))]
        if k == 1 or any(n >= a for n in longer):
            continue
        cuts = []
        for cut in range(1, k):
            left, right = counts[lang, cut, " ".join(words[:cut])], counts[lang, k - cut, " ".join(words[cut:])]
            cuts.append((1000 * a * totals[lang] // (left * right), cut, left, right))
        score, _, left, right = min(cuts)
        rows.append((lang, phrase, a, left, right, totals[lang], score))
    out = []
    for lang in {row[0] for row in rows}:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], n, *r[1:]) for n, r in enumerate(own[:top], 1)]
    return sorted(out)


def corpus(seed, n, words=12):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Ärger", "a\x00b", " "]
    seps = [" ", " ", " ", "\t ", ", ", ".", "\n", " ! "]
    return [
        (pick.choice(["en", "de", None]), "".join(
            pick.choice(vocabulary) + pick.choice(seps) for _ in range(pick.randint(0, 60))))
        for _ in range(n)
    ]


@pytest.mark.parametrize("bits", [1 << 28, 64])
def test_as_counted_plainly(spark, monkeypatch, bits):
    docs = corpus(1, 60)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    found = sorted(map(tuple, collocations(df, least=4, top=15, max_bits=bits).collect()))
    assert found == expected(docs, 4, 15) and len(found) > 20


def test_counts_with_several_filters(spark):
    docs = corpus(2, 80)
    df = spark.createDataFrame(docs, "lang string, text string")
    counts, totals = phrase_counts(df, least=3, max_bits=128)
    every, sums = counted(docs)
    found = {(r.lang, r.k, r.phrase): r.n for r in counts.collect()}
    assert found == {key: n for key, n in every.items() if n >= 3}
    assert {r.lang: r.total for r in totals.collect()} == sums


def test_trie_bursts_and_spills():
    pick = np.random.default_rng(3)
    trie, seen, wanted = HatTrie(burst=5, most=60), Counter(), Counter()

    def take(everything=False):
        for rows, counts in trie.spill(everything):
            for row, n in zip(rows.tolist(), counts.tolist()):
                seen[tuple(row)] += n

    spilled = 0
    for _ in range(50):
        rows = np.unique(pick.integers(1, 9, (30, 4)), axis=0)
        counts = pick.integers(1, 5, len(rows))
        trie.add(rows, counts)
        for row, n in zip(rows.tolist(), counts.tolist()):
            wanted[tuple(row)] += n
        take()
        spilled += bool(seen)
        assert trie.entries <= 60 and trie.entries == module._size(trie.root)
    assert isinstance(trie.root, module.Node) and spilled
    take(everything=True)
    assert seen == wanted and trie.entries == 0


def test_small_tasks_give_the_same(spark, monkeypatch):
    """Chunks of a few words, a trie that spills all the time, word numbers that start anew."""
    docs = corpus(4, 40)
    counter = module._Counter((2,), 1, np.full(1, 2**64 - 1, np.uint64), 0, 1, None)
    monkeypatch.setattr(module, "TOKENS_AT_ONCE", 7)
    monkeypatch.setattr(module, "MOST_WORDS", 5)
    counter.tries[2] = HatTrie(burst=2, most=4)
    found = Counter()
    batches = [b for lang, text in docs for b in counter.read(lang or "und", text.encode())]
    for batch in [*batches, *counter.end()]:
        for row in batch.to_pylist():
            found[row["lang"], 2, row["phrase"]] += row["n"]
    every, _ = counted(docs, 2)
    assert found == {key: n for key, n in every.items() if key[1] == 2}


def test_exact_beyond_64_bits(spark):
    big = 4 * 10**9
    counts = spark.createDataFrame(
        [("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)], "lang string, phrase string, k int, n long")
    totals = spark.createDataFrame([("en", 10**18)], "lang string, total long")
    module_counts = module.phrase_counts
    try:
        module.phrase_counts = lambda *args: (counts, totals)
        row = collocations(counts).first()
    finally:
        module.phrase_counts = module_counts
    assert row.score == 1000 * (big - 1) * 10**18 // (big * big)


def test_awkward_tables(spark):
    found = collocations(awkward(spark), least=3).collect()
    assert {r.lang for r in found} <= {"en", "de", "fr", "und"}
    assert collocations(empty(spark)).count() == 0

"""Exact, line and near deduplication against plain Python."""

import hashlib
import random
from collections import Counter

import pytest
from helpers import awkward, empty, prose

from tidemark.llm.exact_dedup import exact_dedup, without_copies
from tidemark.llm.line_dedup import (
    filter_bits, line_dedup, line_key, repeated_filter, suspects, without_common_lines,
)
from tidemark.llm.simhash import (
    components, covering_masks, fingerprint, links, simhash, without_near_copies,
)


def test_exact_groups_of_awkward_rows(spark):
    docs = awkward(spark)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    found = exact_dedup(docs, salts=3).collect()
    assert len(found) == len(texts)
    for row in found:
        text = row["row"].text or ""
        ids = [i for i, t in texts if t == text]
        known = [i for i in ids if i is not None]
        assert row.group_size == len(ids)
        assert row.keep_id == (max(known) if known else None)
        assert row.kept == (row["row"].doc_id == row.keep_id)
        assert bytes(row.digest) == hashlib.sha256(text.encode()).digest()
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    assert exact_dedup(empty(spark)).count() == 0


def test_a_hot_text_is_combined_within_tasks(spark):
    rows = [(n, "hot" if n % 3 == 0 else prose(n, 5)) for n in range(3000)]
    found = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(16)).collect()
    hot = [r for r in found if r["row"].text == "hot"]
    assert {(r.keep_id, r.group_size) for r in hot} == {(2997, 1000)}
    assert sum(r.kept for r in found) == 2001


def expected_lines(texts, min_docs):
    keys = [[line_key(x) for x in (t or "").encode().split(b"\n")] for t in texts]
    often = Counter(k for doc in keys for k in set(doc))
    drop = {k for k, n in often.items() if n >= min_docs and k}
    out = []
    for t, doc in zip(texts, keys):
        lines = (t or "").encode().split(b"\n")
        kept = [x for x, k in zip(lines, doc) if k not in drop]
        out.append((b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
    return out


def test_lines_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = docs.collect()
    found = line_dedup(docs, min_docs=2).collect()
    wanted = expected_lines([r.text for r in rows], 2)
    assert sorted((r.kept_text or "", r.n_lines, r.n_dropped) for r in found) == sorted(wanted)
    after = without_common_lines(docs, min_docs=2)
    assert after.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in after.collect() if r.text is not None)
    assert [r for r in after.collect() if r.text is None and r.n_chars is not None] == []
    assert line_dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("max_bits", [1 << 29, 1 << 19])
def test_lines_by_brute_force_over_many_tasks(spark, max_bits):
    """More partial filters than one task merges; a crowded filter only suspects more."""
    pick = random.Random(3)
    pool = [f" Line {n}\t" for n in range(300)] + ["É", "é", "", "  "]
    texts = ["\n".join(pick.choices(pool, k=pick.randint(1, 12))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(150)
    found = {r["row"].doc_id: (r.kept_text, r.n_lines, r.n_dropped)
             for r in line_dedup(docs, min_docs=10, max_bits=max_bits).collect()}
    assert [found[n] for n in range(600)] == expected_lines(texts, 10)


def test_no_shared_line_is_missed_by_the_filter(spark):
    texts = [f"once {n}\nshared {n // 2}" for n in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(70)
    bits = filter_bits(400)
    held = suspects(docs, bits, repeated_filter(docs, bits), ["doc_id"]).collect()
    assert {bytes(r.key) for r in held} >= {f"shared {n}".encode() for n in range(200)}
    assert len(held) < 500  # few of the 400 lines seen once are suspected


def test_the_first_line_may_stay(spark):
    rows = [(n, f"shared\nown {n}\nShared") for n in range(5)]
    found = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=3, keep_first=True)
    texts = {r["row"].doc_id: r.kept_text for r in found.collect()}
    assert texts == {0: "shared\nown 0"} | {n: f"own {n}" for n in range(1, 5)}


def test_masks_cover_every_pair_within_the_radius():
    masks = covering_masks(list(range(64)))
    assert len(masks) == 15
    pick = random.Random(5)
    for _ in range(20_000):
        differing = sum(1 << b for b in pick.sample(range(64), pick.randint(0, 3)))
        assert any(differing & mask == 0 for mask in masks)


def test_fingerprint_counts_repeats_and_needs_a_majority():
    import xxhash
    one = xxhash.xxh64_intdigest(b"a b c", 42)
    assert fingerprint("A b  c") % 2**64 == one
    assert fingerprint("") == fingerprint(None) == fingerprint(" \n") == 0
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in (b"a a a", b"a a b", b"a b c")]
    wanted = sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > 3)
    assert fingerprint("a a a b c") % 2**64 == wanted


def brute_components(values, radius=3):
    root = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            least = min(root[b] for b in values if ((a ^ b) % 2**64).bit_count() <= radius)
            if least < root[a]:
                root[a], changed = least, True
    return root


@pytest.mark.parametrize("most", [1, 4096])
def test_links_connect_what_the_radius_connects(spark, most):
    """Also where every bucket is split by the second masks. Chains, a dense cluster, strays."""
    pick = random.Random(8)
    values = {pick.getrandbits(64) for _ in range(60)}
    chain = pick.getrandbits(64)
    for bit in range(0, 40, 3):
        chain ^= 0b111 << bit
        values.add(chain)
    centre = pick.getrandbits(64)
    for _ in range(120):
        values.add(centre ^ sum(1 << b for b in pick.sample(range(20), pick.randint(0, 4))))
    signed = sorted(v - 2**64 if v >> 63 else v for v in values)
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    pairs = links(frame, most=most)
    assert pairs.count() < 15 * 15 * len(signed)
    found = {r.node: r.root for r in components(pairs).collect()}
    assert {v: found.get(v, v) for v in signed} == brute_components(signed)


def test_components_of_a_long_path_and_nothing(spark):
    path = spark.createDataFrame([(n, n + 1) for n in range(200)], "a long, b long")
    assert {(r.node, r.root) for r in components(path).collect()} == {(n, 0) for n in range(1, 201)}
    assert components(path.where("a < 0")).count() == 0


def test_near_copies_of_awkward_rows(spark):
    docs = awkward(spark)
    found = simhash(docs).collect()
    assert len(found) == docs.count()
    zero = [r for r in found if r.fp == 0]
    assert len(zero) == 4 and {r.component_id for r in zero} == {3}
    copies = [r for r in found if r.fp == fingerprint(prose(1, 80))]
    assert [r.component_id for r in copies] == [0, 0, 0]
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert len({fingerprint(t) for t in texts}) == len(texts) == 9
    assert simhash(empty(spark)).count() == 0 and without_near_copies(empty(spark)).count() == 0


def test_one_near_copy_stays(spark):
    base = prose(11, 400).split()
    rows = []
    for n in range(40):
        words = list(base)
        words[200] = f"changed{n}"
        rows.append((n, " ".join(words)))
    rows.append((100, prose(12, 300)))
    kept = without_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in kept} == {
        min(i for i, t in rows if root == brute[fingerprint(t)])
        for brute in [brute_components(sorted({fingerprint(t) for _, t in rows}))]
        for root in set(brute.values())
    }

"""The near-copy stage finds pairs by SimHash under covering masks; bands only add to that."""

import random

import numpy as np

from helpers import prose

import tidemark.llm.near_copies as near
from tidemark.llm.simhash import RADIUS, covering_masks

MASKS = covering_masks(list(range(64)))


def edited(text, place):
    words = text.split()
    words[place] = "changed"
    return " ".join(words)


def share(a, b):
    return any((x ^ y) & m == 0 for x, y in zip(a, b) for m in MASKS)


def test_near_copies_are_found_without_bands(spark, monkeypatch):
    """One changed word of 400, a similarity of 0.97 to 0.98."""
    monkeypatch.setattr(near, "band_keys", lambda hashed: [])
    texts = {2 * n + k: edited(prose(n, 400), 30 + n) if k else prose(n, 400) for n in range(30) for k in (0, 1)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = near.without_similar(docs)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 60, 2))


def test_fingerprints_within_the_radius_share_a_key(spark):
    pick, rows = random.Random(4), []
    for n in range(200):
        value = [pick.getrandbits(64) for _ in range(near.PRINTS)]
        other = [pick.getrandbits(64) for _ in range(near.PRINTS)]
        other[n % near.PRINTS] = value[n % near.PRINTS] ^ sum(1 << b for b in pick.sample(range(64), RADIUS))
        rows += [(2 * n, [near._signed(x) for x in value]), (2 * n + 1, [near._signed(x) for x in other])]
    found = near.covers(spark.createDataFrame(rows, "fp long, prints array<long>")).collect()
    keys = {}
    for r in found:
        keys.setdefault(r.fp, set()).add(r.key)
    assert all(len(k) == len(MASKS) * near.PRINTS for k in keys.values())
    assert all(keys[2 * n] & keys[2 * n + 1] for n in range(200)) and not keys[0] & keys[2]


def test_recall_of_the_masks_alone():
    """At a similarity of 0.95 nearly all pairs share a key; far ones do not."""
    state = np.random.default_rng(3)

    def found(same, own):
        x = state.integers(0, 1 << 63, same + 2 * own, np.uint64)
        return share(near.prints(x[: same + own]), near.prints(np.r_[x[:same], x[same + own :]]))

    assert sum(found(380, 10) for _ in range(200)) >= 185
    assert not any(found(20, 380) for _ in range(200))
    assert near.prints(near.shingles(None)) == []

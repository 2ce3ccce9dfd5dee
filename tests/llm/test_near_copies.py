"""The pipeline's near copies against brute-force Jaccard similarity of five-word shingles."""

import random
import time

import corpus_pipeline
import numpy as np
import pandas as pd
from conftest import SF_DIR
from helpers import awkward, empty, prose

from tidemark.llm.near_copies import _pairs, band_keys, connected, shingles, without_similar


def runs(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def survivors(texts):
    """The smallest id of each component; all pairs are compared."""
    sets = {i: runs(t) for i, t in texts.items()}
    group = {i: i for i in sets}
    near = [(a, b) for a in sets for b in sets if a < b
            and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    while True:
        before = dict(group)
        for a, b in near:
            group[a] = group[b] = min(group[a], group[b])
        if group == before:
            return sorted(set(group.values()))


def edited(text, places):
    words = text.split()
    for n in places:
        words[n] = f"changed{n}"
    return " ".join(words)


def test_the_stage_finds_what_brute_force_finds(spark):
    pick, texts = random.Random(7), {}
    for n in range(40):  # short and long texts with one to many changed words, around 0.8
        base = prose(100 + n, pick.choice([60, 200, 400]))
        size = len(base.split())
        texts[10 * n] = base
        for k, edits in enumerate([1, size // 60, size // 45, size // 40, size // 30]):
            texts[10 * n + k + 1] = edited(base, pick.sample(range(5, size - 5), edits))
    for n in range(60):  # one text with many near copies, all in the same buckets
        texts[1000 + n] = edited(prose(3, 120), [n + 20])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    wanted = survivors(texts)
    assert sorted(r.doc_id for r in kept.collect()) == wanted and 1000 in wanted and 1001 not in wanted


def test_one_changed_word_of_sixty_is_a_near_copy(spark):
    texts = {2 * n + k: edited(prose(n, 60), [30] * k) for n in range(30) for k in (0, 1)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()) == list(range(0, 60, 2))


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in without_similar(docs).collect()) == [
        i for i in survivors(texts) if runs(texts[i])
        or i == min(j for j in texts if not runs(texts[j]))]


def test_large_buckets_connect_as_all_pairs_would():
    pick = random.Random(5)
    base = [list(range(n * 1000, n * 1000 + 100)) for n in range(3)]
    sets = [np.unique([x if pick.random() > 0.08 else pick.randrange(10**6) for x in base[n % 3]])
            for n in range(60)]
    near = [(i, j) for i in range(60) for j in range(i)
            if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]

    def parts(pairs):
        label = list(range(60))
        for i, j in pairs:
            label = [label[i] if x == label[j] else x for x in label]
        return {frozenset(k for k in range(60) if label[k] == x) for x in label}

    assert parts(connected(np.array(sets, object))) == parts(near) and near


def test_a_bucket_of_unlike_texts_with_a_common_passage():
    """Half of every text is the same; a thousand of them take no time, and a hidden pair is found."""
    passage = np.arange(150)
    sets = [np.r_[passage, np.arange(1000 * (n + 1), 1000 * (n + 1) + 150)] for n in range(1000)]
    sets[700] = np.r_[sets[20][:-10], np.arange(5)- 10]
    began = time.process_time()
    found = connected(np.array(sets, object))
    assert found.tolist() == [[20, 700]] and time.process_time() - began < 2


def star(keys, fps, batch):
    df = pd.DataFrame({"key": keys, "fp": fps})
    parts = list(_pairs(df.iloc[i : i + batch] for i in range(0, len(df), batch)))
    return pd.concat(parts)


def test_pairs_of_buckets_that_come_in_parts():
    sizes = [3, 1, 50, 16, 17, 2, 40]
    keys = np.repeat(np.arange(len(sizes)), sizes)
    fps = np.arange(len(keys)) * 7
    want = set()
    for key, size in enumerate(sizes):
        own = fps[keys == key].tolist()
        want |= {(None, a, b) for n, a in enumerate(own) for b in own[n + 1 :]} if size <= 16 else {
            (key, own[0], b) for b in own[1:]}
    for batch in (1000, 20, 7, 1):
        found = star(keys, fps, batch)
        got = [(None if key is pd.NA else key, a, b) for key, a, b in zip(found["key"], found["a"], found["b"])]
        assert set(got) == want and len(got) == len(want)


def test_chains_that_the_pivot_does_not_see(spark):
    """Every text is similar to the next one; the ends and most others are not similar to the pivot."""
    base, texts = prose(77, 300), {}
    words = base.split()
    for n in range(60):
        for place in range(3 * n, 3 * n + 3):
            words[place] = f"moved{place}"
        texts[n] = " ".join(words)
    for n in range(60, 130):
        texts[n] = edited(base, [200 + n % 70])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r.doc_id for r in without_similar(docs).collect()) == survivors(texts)


def test_bands_of_pairs_at_the_limit():
    """All of 300 pairs at 0.8 share a band."""
    random_state = np.random.default_rng(1)
    for _ in range(300):
        x = random_state.integers(0, 1 << 63, 100, np.uint64)
        a, b = x[:90], np.r_[x[:80], x[90:]]
        assert set(band_keys(a)) & set(band_keys(b))
    assert band_keys(shingles(None)) == [] and len(shingles("one two")) == 1


def test_awkward_rows(spark):
    docs = awkward(spark)
    kept = without_similar(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, -9), (False, 0), (False, 2), (False, 3), (False, 5), (False, 7), (False, 8),
        (True, 0), (True, 0)]
    assert without_similar(empty(spark)).count() == 0

"""Every labelled text is learned from and sets thresholds, whatever the size of the first sample."""

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity

WORDS = [w + c for w in "the of and to in is that it was for".split() for c in "abcdefgh"]


def insults(spark, n, seed=3):
    """Texts, labels of most; one of four is toxic by one of two words. ``told`` is what is right."""
    pick, rows = random.Random(seed), []
    for i in range(n):
        words = [pick.choice(WORDS) for _ in range(40)]
        if i % 4 == 0:
            words.insert(pick.randint(0, 40), pick.choice(["scoundrel", "blackguard"]))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 5], "doc_id long, toxic int")
    return docs, labels, [r[2] for r in rows]


def scores(docs, labels, **bounds):
    found = toxicity.toxicity_scores(docs, labels, **bounds).select("row.doc_id", "score").collect()
    return [r.score for r in sorted(found)]


@pytest.mark.parametrize("bounds", [{"training_bytes": 1}, {"training": 40}])
def test_texts_outside_the_sample_are_learned_from(spark, monkeypatch, bounds):
    """A sample of nothing or of a few texts cannot tell them apart; several shards, none of them alone."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 800)
    docs, labels, told = insults(spark, 3000)
    found = scores(docs, labels, **bounds)
    held = [n for n in range(len(told)) if n % 5 == 0]
    assert np.mean([(found[n] >= 0.5) == told[n] for n in held]) >= 0.95


def test_scores_do_not_depend_on_how_the_table_is_stored(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 60)
    docs, labels, _ = insults(spark, 200)
    assert scores(docs.repartition(1), labels) == scores(docs.orderBy("text").repartition(7), labels.repartition(3))


def test_labels_of_one_kind_give_the_share_of_all(spark):
    docs, labels, _ = insults(spark, 40)
    known = labels.where("toxic = 0").count()
    assert scores(docs, labels.where("toxic = 0"), training=3) == pytest.approx([1 / (known + 2)] * 40)


def test_the_filter_keeps_every_labelled_text(spark):
    texts = spark.range(-30_000, 30_000).selectExpr("id * 7919 AS id", "'x' AS text")
    known = texts.where("id % 30 = 0").select("id")
    rows = known.count()
    found = toxicity.perhaps_labelled(texts, known, rows)
    assert found.join(known, "id", "left_semi").count() == rows and found.count() < 5 * rows


def test_parts_of_words():
    for word in ["a", "abc", "abcd", "abcde", "abcdef", "abcdefghi", "abcdefghijkl", "naïve", "überlänge", "x_1"]:
        parts = [f"={word}"] + [f"^{word[:n]}" for n in range(3, 9) if len(word) > n]
        parts += [f"${word[-n:]}" for n in (3, 5) if len(word) > n]
        found = [zlib.crc32(p.encode()) % toxicity.BUCKETS for p in parts]
        assert toxicity.word_parts(word) == found + [-1] * (toxicity.PARTS - len(found))


def test_blocks_of_long_texts(monkeypatch):
    pick = np.random.default_rng(2)
    response = pick.normal(size=(30, 6, toxicity.FILTERS)).astype(np.float32)
    for n in (0, 1, 2, 7, 8, 9, 50):
        at = pick.integers(0, 30, n)
        monkeypatch.setattr(toxicity, "BLOCK", 8)
        most, where = toxicity.pooled_blocks(response, at)
        whole, there = toxicity.pooled(response[at])
        assert most.tolist() == whole.tolist() and where.tolist() == there.tolist()


def test_thresholds_of_counted_rows_are_those_of_all_rows():
    pick = np.random.default_rng(5)
    logits, y = np.round(pick.normal(size=60), 1), pick.integers(0, 2, 60)
    spoken, often = pick.integers(0, 5, 60), pick.integers(1, 4, 60)
    level = float((often * y).sum() / often.sum())
    counted = toxicity.thresholds(logits, y, spoken, level, level, often)
    each = np.repeat(np.arange(60), often)
    assert counted.tolist() == toxicity.thresholds(logits[each], y[each], spoken[each], level, level).tolist()

    def mistakes(cut):
        return int((often * ((logits > cut) != y)).sum())

    assert mistakes(counted[-1]) == min(map(mistakes, [*(np.unique(logits) + 0.05), -9]))

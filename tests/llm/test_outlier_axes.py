"""Each axis of the outlier test alone rejects an extreme text, and only an extreme one."""

import random

import pytest

from tidemark.llm.quality_rules import quality_rules

N = 120  # words of a text


def fresh(pick, n):
    return [pick.choice(["word", "thing", "another"]) + str(pick.randint(0, 10**6)) for _ in range(n)]


def text(axis, much, pick):
    """Prose whose only oddity lies on one axis; ``much`` is its size."""
    words = fresh(pick, N)
    if axis == "length":
        return " ".join(w * much for w in words)
    if axis == "symbols":
        return " ".join(w + ("%" if k < much else "") for k, w in enumerate(words))
    if axis == "lines":  # one-word lines between lines of other words; no window of three recurs
        return "\n".join(f"menu\n{w}" for w in words[:much]) + "\n" + " ".join(words[2 * much:])
    return " ".join([*words[:much], *words[2 * much:], *words[:much]])  # a passage that occurs twice


@pytest.mark.parametrize("axis, junk, clean", [
    ("length", 3, 1), ("symbols", 60, 4), ("lines", 55, 4), ("words", 29, 10)])
def test_an_extreme_on_one_axis_goes_and_a_slight_one_stays(spark, axis, junk, clean):
    pick = random.Random(axis)
    rows = [(n, " ".join(fresh(pick, N)), "en", "s", None) for n in range(200)]
    rows += [(200 + n, text(axis, junk, pick), "en", "s", True) for n in range(5)]
    rows += [(300 + n, text(axis, clean, pick), "en", "s", False) for n in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")
    found = quality_rules(docs).select("row.junk", "kept", "base_failed").collect()
    assert not any(r.base_failed for r in found)
    assert all(r.kept != bool(r.junk) for r in found)

"""The pipeline against the same stages in plain Python."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from conftest import SF_DIR
from helpers import awkward, empty

from tidemark.llm.line_dedup import line_key
from tidemark.llm.mixing import mix
from tidemark.llm.quality_rules import quality_rules

LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found.append(stage(spark, found[-1], SF_DIR).persist())
    yield found
    for df in found[1:]:
        df.unpersist()


def test_stages_keep_the_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages)


def test_quality_stage(stages):
    kept = quality_rules(stages[0]).where("kept").select("row.*")
    assert sorted(map(tuple, stages[1].collect())) == sorted(map(tuple, kept.collect()))
    assert 0 < stages[1].count() < stages[0].count()


def test_line_stage(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    often = Counter(k for t in before.values() for k in {line_key(x) for x in t.encode().split(b"\n")})
    after = {r.doc_id: r for r in stages[2].collect()}
    assert after.keys() == before.keys()
    for i, text in before.items():
        wanted = "\n".join(x for x in text.split("\n") if not line_key(x.encode()) or often[line_key(x.encode())] < 10)
        assert after[i].text == wanted and after[i].n_chars == len(wanted)
    assert any(after[i].text != before[i] for i in before)


def test_near_copy_stage(stages):
    """Of texts linked by a Jaccard similarity of 0.8 or more of five-word shingles one stays."""
    sets = {}
    for r in stages[2].collect():
        found = words(r.text)
        sets[r.doc_id] = {tuple(found[i : i + 5]) for i in range(max(len(found) - 4, 1))}
    group = {i: i for i in sets}
    near = [
        (a, b) for a in sets for b in sets
        if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in near:
            group[a] = group[b] = min(group[a], group[b])
    assert near and sorted(r.doc_id for r in stages[3].collect()) == sorted(set(group.values()))


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text.translate(LOWER)) if w]


def test_mixing_stage(stages):
    copies = {r["row"].doc_id: r.copies for r in mix(stages[3]).collect() if r.copies}
    assert Counter(r.doc_id for r in stages[4].collect()) == Counter(copies)


def test_the_run_is_its_stages(spark, stages):
    run = corpus_pipeline.run(spark, SF_DIR)
    last = corpus_pipeline.STAGES[-1][1](spark, stages[-1], SF_DIR)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, last.collect()))


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_tables_pass_through(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        docs.count()

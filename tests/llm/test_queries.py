"""Every query of the subpackage against the same query in SQL, or against brute force."""

import hashlib
import struct
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import public_tokenizers  # noqa: E402
from conftest import SF_DIR  # noqa: E402
from tidemark.llm.oracle import ORACLE  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402
from tidemark.llm.simhash import fingerprint  # noqa: E402


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", ORACLE)
def test_same_rows(spark, other, name):
    df = QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    found = [tuple(row) for row in df.select(*names).collect()]
    wanted = other.execute(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert len(found) > 0


def test_every_operator_is_registered():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 11))
    assert "pipeline" in names


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text or "" for row in rows}


def test_tokens_are_the_librarys(spark, texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r.doc_id: r for r in QUERIES["op3_bpe"](spark, SF_DIR).collect()}
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        row = found[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_near_copies_by_brute_force(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op6_simhash"](spark, SF_DIR).collect()}
    prints = {doc_id: fingerprint(text) % 2**64 for doc_id, text in texts.items()}
    group = {doc_id: doc_id for doc_id in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            least = min(group[b] for b in texts if (prints[a] ^ prints[b]).bit_count() <= 3)
            if least < group[a]:
                group[a], changed = least, True
    for doc_id in texts:
        assert found[doc_id].fingerprint == f"{prints[doc_id]:016x}"
        assert found[doc_id].component_id == group[doc_id]


@pytest.mark.parametrize(("name", "label", "least"), [
    ("op2_quality_classifier", "quality", 0.9), ("op10_toxicity", "toxic", 0.8)])
def test_held_out_accuracy(spark, name, label, least):
    """Trained on other documents only, both classifiers tell most held-out documents."""
    sf_dir = SF_DIR.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = QUERIES[name](spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    right = sum(row.predicted == row[label] for row in scored)
    assert len(scored) > 40 and right >= least * len(scored)
    assert all(0 <= row.score <= 1 for row in scored)

"""Every sample query against the same query in a second engine."""

import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

from conftest import SF_DIR  # noqa: E402
from workload.oracle import ORACLE  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, other, name):
    df = QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    found = [tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    wanted = other.execute(
        f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({ORACLE[name]})"
    ).fetchall()
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert len(found) > 0


def test_entry(spark):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__
    df = __spark_entry__.entry(spark)
    assert df.count() > 0

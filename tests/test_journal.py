"""Replacements that lose their driver on the way."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tidemark.sinks import journal, recover, replace_partition, replace_partitions
from tidemark.sinks.files import Files

DAYS = [dt.date(2024, 1, day) for day in (14, 15, 16)]
SCHEMA = "id long, as_of_date date, part string"


class Lost(BaseException):
    """The driver is gone."""


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def stored(spark, root):
    return rows(spark.read.schema(SCHEMA).parquet(root))


def keys(parts=("a", "b c")):
    return {"as_of_date": DAYS, "part": list(parts)}


BEFORE = [(i, day, part) for i, (day, part) in enumerate((d, p) for d in DAYS for p in ("a", "b c"))]
NEW = [(10, DAYS[0], "a"), (11, DAYS[1], "b c"), (12, DAYS[1], "b c")]


@pytest.fixture
def table(spark, root):
    replace_partitions(frame(spark, *BEFORE, (99, DAYS[0], "other")), root, keys(("a", "b c", "other")))
    return root


def lose(monkeypatch, owner, name, after):
    """Let ``after`` calls pass, then lose the driver."""
    real, left = getattr(owner, name), [after]

    def call(*args, **kwargs):
        if not left[0]:
            raise Lost
        left[0] -= 1
        return real(*args, **kwargs)

    monkeypatch.setattr(owner, name, call)
    monkeypatch.setattr(journal.Replacement, "abandon", lambda self: None)


def left_behind(spark, root):
    files = Files(spark, root)
    return files.names(journal.JOURNAL), files.names(journal.STAGED)


def test_nothing_is_left_behind(spark, table):
    assert replace_partitions(frame(spark, *NEW), table, keys()) == 3
    assert stored(spark, table) == [*NEW, (99, DAYS[0], "other")] and left_behind(spark, table) == ([], [])


def test_lost_before_the_commit(spark, table, monkeypatch):
    lose(monkeypatch, Files, "write_text", 0)
    with pytest.raises(Lost):
        replace_partitions(frame(spark, *NEW), table, keys())
    monkeypatch.undo()
    assert stored(spark, table) == [*BEFORE, (99, DAYS[0], "other")]
    assert recover(spark, table) == 0 and len(left_behind(spark, table)[1]) == 1
    assert recover(spark, table, dt.timedelta(0)) == 0 and left_behind(spark, table) == ([], [])
    assert stored(spark, table) == [*BEFORE, (99, DAYS[0], "other")]


@pytest.mark.parametrize(("name", "after"), [
    ("exists", 0), ("move", 1), ("move", 2), ("empty", 0), ("empty", 2), ("delete", 1), ("delete", 3)])
def test_lost_after_the_commit(spark, table, monkeypatch, name, after):
    """Wherever the rest of the work stops, the new state comes about, and nothing else."""
    if name == "exists":
        lose(monkeypatch, journal, "finish", 0)
    else:
        lose(monkeypatch, Files, name, after)
    with pytest.raises(Lost):
        replace_partitions(frame(spark, *NEW), table, keys())
    monkeypatch.undo()
    assert recover(spark, table) == 1
    assert stored(spark, table) == [*NEW, (99, DAYS[0], "other")] and left_behind(spark, table) == ([], [])
    assert recover(spark, table) == 0


def test_the_next_run_completes_a_lost_one(spark, table, monkeypatch):
    lose(monkeypatch, journal, "finish", 0)
    with pytest.raises(Lost):
        replace_partitions(frame(spark, *NEW), table, keys())
    monkeypatch.undo()
    # A run that meets none of its partitions lets it be; it may still be at work.
    replace_partition(spark.range(1), table, {"as_of_date": DAYS[0], "part": "other"})
    assert len(left_behind(spark, table)[0]) == 1
    replace_partition(spark.range(5, 6), table, {"as_of_date": DAYS[2], "part": "a"})
    assert sorted(stored(spark, table)) == sorted([(0, DAYS[0], "other"), (5, DAYS[2], "a"), *NEW])
    assert left_behind(spark, table) == ([], [])


def test_a_query_that_fails_leaves_no_trace(spark, table):
    broken = frame(spark, *NEW).withColumn("id", F.raise_error(F.lit("no luck")).cast("long"))
    with pytest.raises(PySparkException, match="no luck"):
        replace_partitions(broken, table, keys())
    assert stored(spark, table) == [*BEFORE, (99, DAYS[0], "other")] and left_behind(spark, table) == ([], [])


def test_few_looks_at_the_folders(spark, table, monkeypatch):
    """Emptying costs a look at each stored date, not one for every combination of keys."""
    looks = []
    real = Files.names
    monkeypatch.setattr(Files, "names", lambda self, *args, **kw: looks.append(args) or real(self, *args, **kw))
    many = {"as_of_date": DAYS, "part": ["a", "b c", *[f"never{i}" for i in range(200)]]}
    assert replace_partitions(frame(spark), table, many) == 0
    assert stored(spark, table) == [(99, DAYS[0], "other")] and len(looks) < 30

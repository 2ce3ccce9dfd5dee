"""Counts kept per file against full scans."""

import datetime as dt
from pathlib import Path
from random import Random

import pytest
from conftest import rows
from tidemark.operators import null_check
from tidemark.plans import kept_null_check
from tidemark.sources import QualityRule

RUN = dict(table="t", source_type="lake", run_ts="2024-02-01 06:00:00")
RULES = [
    QualityRule("t", ("a",), (), ("None",)), QualityRule("t", ("b", "a"), (), ("ConditionalNullsNonVBO",)),
    QualityRule("t", ("a", "b"), (), ("ConditionalNullsNonVBO",)),
]
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def some(spark, seed, days=DAYS):
    random = Random(seed)
    return spark.createDataFrame([
        (random.choice(days), random.choice([None, "VBA", "VBO"]), random.choice(["", "x", None]), random.choice([1, None]))
        for _ in range(80)], "as_of_date date, account_type string, a string, b int")


def add(df, root):
    df.coalesce(1).write.mode("append").partitionBy("as_of_date").parquet(root)


def files_read(monkeypatch):
    """Files that each call counts."""
    import tidemark.plans.kept_counts as plan
    plain, seen = plan._count, []

    def count(spark, root, schema, rules, kept, fresh, type_column):
        seen.append(len(fresh))
        plain(spark, root, schema, rules, kept, fresh, type_column)

    monkeypatch.setattr(plan, "_count", count)
    return seen


def test_only_new_files_are_read(spark, root, tmp_path, monkeypatch):
    kept, seen = str(tmp_path / "kept"), files_read(monkeypatch)
    schema = some(spark, 0).schema
    check = lambda rules=RULES, **more: rows(kept_null_check(spark, root, schema, rules, kept, **RUN, **more))
    full = lambda rules=RULES, **more: rows(null_check(spark.read.schema(schema).parquet(root), rules, **RUN, **more))
    assert check() == [] and len(check(as_of=DAYS[0])) == len(RULES)
    add(some(spark, 1), root)
    assert check() == full() and seen == [2]
    assert check() == full() and seen == [2]
    add(some(spark, 2, DAYS[1:]), root)
    assert check() == full() and seen == [2, 1]
    assert check(as_of=DAYS[1]) == full(as_of=DAYS[1]) and seen == [2, 1]
    # Another rule has to be counted everywhere, the same one written otherwise nowhere.
    more = [*RULES, QualityRule("t", ("b",), (), ("ConditionalNulls",))]
    assert check(more, as_of=DAYS[0]) == full(more, as_of=DAYS[0]) and seen == [2, 1, 1]


def test_gone_replaced_and_empty_files(spark, root, tmp_path, monkeypatch):
    kept, seen = str(tmp_path / "kept"), files_read(monkeypatch)
    schema = some(spark, 0).schema
    check = lambda: rows(kept_null_check(spark, root, schema, RULES, kept, **RUN))
    full = lambda: rows(null_check(spark.read.schema(schema).parquet(root), RULES, **RUN))
    add(some(spark, 1), root)
    some(spark, 1).where("false").drop("as_of_date").coalesce(1).write.parquet(f"{root}/as_of_date=2024-01-03")
    assert check() == full() and seen == [3]
    some(spark, 9, DAYS[:1]).drop("as_of_date").coalesce(1).write.mode("overwrite").parquet(f"{root}/as_of_date=2024-01-01")
    for file in Path(f"{root}/as_of_date=2024-01-02").glob("*.parquet"):
        file.unlink()
    assert check() == full() and seen == [3, 1]
    assert check() == full() and seen == [3, 1]


def test_a_file_replaced_while_it_is_counted(spark, root, tmp_path, monkeypatch):
    import tidemark.plans.kept_counts as plan
    schema = some(spark, 0).schema
    add(some(spark, 1, DAYS[:1]), root)
    plain = plan._count

    def late(*given):
        some(spark, 3, DAYS[:1]).drop("as_of_date").coalesce(1).write.mode("overwrite").parquet(f"{root}/as_of_date=2024-01-01")
        given[5].update({key: (day, f"{root}/as_of_date=2024-01-01") for key, (day, _) in given[5].items()})
        plain(*given)

    monkeypatch.setattr(plan, "_count", late)
    check = lambda: kept_null_check(spark, root, schema, RULES, str(tmp_path / "kept"), **RUN)
    with pytest.raises(RuntimeError, match="changed"):
        check()
    monkeypatch.setattr(plan, "_count", plain)
    assert rows(check()) == rows(null_check(spark.read.schema(schema).parquet(root), RULES, **RUN))

import datetime as dt

import pytest
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import stored_counts
from tidemark.plans import replace_snapshot, replace_snapshots
from tidemark.sinks import replace_partition, replace_partitions
from tidemark.sinks.files import Files
from tidemark.sources import (
    read_history, read_snapshot, read_snapshots, register_partitions, sync_partitions,
)

D1, D2 = dt.date(2024, 1, 14), dt.date(2024, 1, 15)
SCHEMA = "id long, name string, as_of_date date"


def frame(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id long, name string")


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def stored(spark, root):
    return rows(read_history(spark, root, schema(spark)).select("id", "as_of_date"))


def test_replace_keeps_other_dates_and_counts(spark, root):
    assert replace_snapshot(frame(spark, 1, 2), root, D1) == 2
    assert replace_snapshot(frame(spark, 3, 4, 5), root, "2024-01-15") == 3
    assert replace_snapshot(frame(spark, 9), root, D2) == 1
    assert stored(spark, root) == [(1, D1), (2, D1), (9, D2)]


def test_rerun_changes_nothing(spark, root):
    for _ in range(2):
        assert replace_snapshot(frame(spark, 1, 2), root, D1, files=2) == 2
    assert stored(spark, root) == [(1, D1), (2, D1)]


def test_number_of_files(spark, root, tmp_path):
    df = spark.range(1000).select("id", F.lit("x").alias("name"))
    assert replace_snapshot(df, root, D1, files=5) == 1000
    assert len(list((tmp_path / "lake" / "as_of_date=2024-01-14").glob("*.parquet"))) == 5
    assert replace_snapshot(df.coalesce(1), root, D1, max_rows_per_file=300) == 1000
    assert len(list((tmp_path / "lake" / "as_of_date=2024-01-14").glob("*.parquet"))) == 4


@pytest.mark.parametrize("condition", ["false", "id > 100", "id in (select id from gone)"])
def test_empty_result_empties_the_date(spark, root, condition):
    replace_snapshot(frame(spark, 1, 2), root, D1)
    replace_snapshot(frame(spark, 3), root, D2)
    frame(spark, 1).where("id > 1").createOrReplaceTempView("gone")
    assert replace_snapshot(frame(spark, 3).where(condition), root, D2) == 0
    assert stored(spark, root) == [(1, D1), (2, D1)]
    assert read_snapshot(spark, root, D2, schema(spark)).count() == 0


def test_failing_query_leaves_the_old_rows(spark, root):
    replace_snapshot(frame(spark, 1, 2), root, D1)
    bad = frame(spark, 3).withColumn("name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(PySparkException, match="broken"):
        replace_snapshot(bad, root, D1)
    assert stored(spark, root) == [(1, D1), (2, D1)]


def test_query_may_read_the_date_it_replaces(spark, root):
    replace_snapshot(frame(spark, 1, 2, 3), root, D1)
    kept = read_snapshot(spark, root, D1, schema(spark)).where("id <> 2")
    assert replace_snapshot(kept, root, D1) == 2
    assert stored(spark, root) == [(1, D1), (3, D1)]


def test_many_dates_at_once(spark, root):
    replace_snapshot(frame(spark, 7), root, "2024-01-13")
    replace_snapshot(frame(spark, 8), root, "2024-01-16")
    day = F.when(F.col("id") < 3, F.lit(D1)).otherwise(F.lit(D2))
    df = frame(spark, 1, 2, 3).withColumn("as_of_date", day)
    assert replace_snapshots(df, root, [D1, D2, "2024-01-16"]) == 3
    assert stored(spark, root) == [(1, D1), (2, D1), (3, D2), (7, dt.date(2024, 1, 13))]


def test_row_outside_the_listed_dates_fails_before_replacing(spark, root):
    replace_snapshot(frame(spark, 1), root, D1)
    df = frame(spark, 2, 3).withColumn("as_of_date", F.when(F.col("id") == 2, F.lit(D1)).otherwise(F.lit(D2)))
    with pytest.raises(PySparkException, match="outside the partitions"):
        replace_snapshots(df, root, [D1])
    assert stored(spark, root) == [(1, D1)]


def test_unwritten_date_reads_as_empty(spark, root):
    replace_snapshot(frame(spark, 1), root, D1)
    missing = read_snapshot(spark, root, D2, schema(spark))
    assert missing.count() == 0 and missing.columns == ["id", "name", "as_of_date"]
    assert rows(stored_counts(missing, "x", "t", D2)) == [("x", "t", D2, 0)]


def test_names_of_partition_directories(spark, root, tmp_path):
    name = "a/b:c=d 100%"
    assert replace_partition(frame(spark, 1), root, {"k": name}) == 1
    assert replace_partition(frame(spark).where("id > 1"), root, {"k": name}) == 0
    folders = [p for p in (tmp_path / "lake").glob("k=*")]
    assert len(folders) == 1 and not list(folders[0].iterdir())


@pytest.mark.parametrize("value", [None, ""])
def test_null_and_empty_keys_are_refused(spark, root, value):
    with pytest.raises(ValueError, match="null or empty"):
        replace_partition(frame(spark, 1), root, {"k": value})
    with pytest.raises(ValueError, match="null or empty"):
        replace_partitions(frame(spark, 1).withColumn("k", F.lit("a")), root, {"k": ["a", value]})
    null_key = frame(spark, 1).withColumn("k", F.lit(value).cast("string"))
    with pytest.raises(PySparkException, match="outside the partitions"):
        replace_partitions(null_key, root, {"k": ["a"]})


def test_several_snapshots_in_one_scan(spark, root):
    days = [D1, D2]
    assert read_snapshots(spark, root, days, schema(spark)).count() == 0
    replace_snapshot(frame(spark, 1), root, D1)
    replace_snapshot(frame(spark, 2, 3), root, D2)
    found = read_snapshots(spark, root, days, schema(spark))
    assert rows(found, "id") == [(1,), (2,), (3,)]
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_written_date_becomes_visible_in_a_catalog_table(spark, root):
    spark.sql(
        f"CREATE TABLE visible (id BIGINT, name STRING, as_of_date DATE) USING parquet "
        f"PARTITIONED BY (as_of_date) LOCATION '{root}'"
    )
    replace_snapshot(frame(spark, 1, 2), root, D1)
    for _ in range(2):
        register_partitions(spark, "visible", [D1, D2])
    spark.catalog.refreshTable("visible")
    assert spark.table("visible").where(F.col("as_of_date") == F.lit(D1)).count() == 2
    spark.sql("DROP TABLE visible")


def test_stored_count_reads_no_data_column(spark, root):
    replace_snapshot(frame(spark, 1, 2), root, D1)
    counted = stored_counts(read_snapshot(spark, root, D1, schema(spark)), "x", "t", D1)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and "PartitionFilters: [isnotnull(as_of_date" in plan


@pytest.mark.parametrize("files", [None, 3])
def test_repeated_tasks_count_once(spark, root, files):
    def fails_at_first(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    df = spark.range(10_000, numPartitions=6).mapInPandas(fails_at_first, "id long")
    spark.sparkContext.setLogLevel("OFF")
    try:
        assert replace_snapshot(df, root, D1, files) == 10_000
        dated = df.withColumn("as_of_date", F.when(F.col("id") % 3 == 0, F.lit(D1)).otherwise(F.lit(D2)))
        assert replace_snapshots(dated, root, [D1, D2]) == 10_000
    finally:
        spark.sparkContext.setLogLevel("ERROR")
    assert spark.read.parquet(root).distinct().count() == spark.read.parquet(root).count() == 10_000


def last_plan(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return runs.apply(runs.size() - 1).physicalPlanDescription()


def test_writing_a_snapshot_neither_sorts_nor_shuffles(spark, root):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert replace_snapshot(df, root, D1) == df.count()
    replace_snapshot(df, root, D1)
    plan = last_plan(spark)
    assert "WriteFiles" in plan and "Sort" not in plan and "Exchange" not in plan


def test_a_date_holding_most_rows_is_split(spark, root, tmp_path):
    df = spark.range(400_000, numPartitions=8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("name"),
        F.when(F.col("id") % 20 == 0, F.lit(D1)).otherwise(F.lit(D2)).alias("as_of_date"),
    )
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advisory, "4MB")
    try:
        assert replace_snapshots(df, root, [D1, D2]) == 400_000
    finally:
        spark.conf.unset(advisory)
    assert len(list((tmp_path / "lake" / "as_of_date=2024-01-15").glob("*.parquet"))) > 1


def test_nothing_written_at_all(spark, root):
    df = frame(spark, 1).where("id > 1").withColumn("as_of_date", F.lit(D1))
    assert replace_snapshots(df, root, [D1, D2]) == 0
    replace_snapshots(frame(spark, 1).withColumn("as_of_date", F.lit(D1)), root, [D1, D2])
    assert stored(spark, root) == [(1, D1)]
    assert replace_snapshots(df, root, [D1, D2]) == 0
    assert stored(spark, root) == []


def test_catalog_follows_the_folders(spark, root):
    spark.sql("DROP TABLE IF EXISTS followed")
    spark.sql(f"CREATE TABLE followed (id BIGINT, name STRING, as_of_date DATE) USING parquet "
              f"PARTITIONED BY (as_of_date) LOCATION '{root}'")
    assert sync_partitions(spark, "followed", root) == (0, 0)
    for day in (D1, D2):
        replace_snapshot(frame(spark, 1, 2), root, day)
    assert spark.table("followed").count() == 0
    assert sync_partitions(spark, "followed", root) == (2, 0)
    assert spark.table("followed").count() == 4
    # Both directions at once; what is no date is nobody's partition.
    Files(spark, root).delete(f"as_of_date={D1}")
    replace_snapshot(frame(spark, 3), root, "2024-01-16")
    frame(spark, 9).write.parquet(f"{root}/as_of_date=soon")
    assert sync_partitions(spark, "followed", root) == (1, 1)
    assert [row[0] for row in spark.sql("SHOW PARTITIONS followed").collect()] == [
        "as_of_date=2024-01-15", "as_of_date=2024-01-16"]
    # An emptied date keeps its folder.
    replace_snapshot(frame(spark), root, D2)
    assert sync_partitions(spark, "followed", root) == (0, 0) and spark.table("followed").count() == 1
    spark.sql("DROP TABLE followed")

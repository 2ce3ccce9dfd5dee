import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions import as_date, run_variables
from tidemark.operators import (
    classify_log, error_code, error_lines, metrics_export, null_check, previous_snapshot,
    previous_snapshot_dates, previous_snapshots, rows_print, stored_counts, transform_counts,
)
from tidemark.operators.metrics_export import EXPORT_COLUMNS
from tidemark.plans import (
    IngestionError, export_errors, ingest_domain, replace_snapshot, report_batch, write_transform_counts,
)
from tidemark.schemas import INGESTION_MAPPING, METRIC_MAPPING, SQL_ERRORS, TRANSFORM_COUNTS
from tidemark.sinks import shared_path, write_lines
from tidemark.sources import (
    QualityRule, mapped_tables, previous_stored_dates, read_ingestion_mapping, read_metric_mapping,
    run_stored_query, stored_days,
)

D1, D2, D3 = (dt.date(2023, 1, day) for day in (8, 9, 10))
RUN_TS = "2023-01-11 06:00:00"


# Two databases share a table name; one domain has a single table, one has none.
LINES = [
    ("crm_visits", "Visits", "web", "crm", "lake", "traffic"),
    ("crm_visits_old", "Visits", "web", "crm", "vault", "traffic"),
    ("wms_bins", "bins", "stock/now", "wms", "lake", "storage"),
]


@pytest.fixture
def ingestion_file(tmp_path):
    path = tmp_path / "mapping.txt"
    path.write_text("\n".join("|".join(line) for line in [INGESTION_MAPPING.names, *LINES]) + "\n")
    return str(path)


def test_ingestion_mapping(spark, ingestion_file):
    read = lambda *wanted: rows(read_ingestion_mapping(spark, ingestion_file, *wanted))
    assert read() == LINES and read("traffic") == LINES[:2] and read("storage") == LINES[2:]
    assert read("traffic", "VISITS") == LINES[:2] and read(None, "BINS") == LINES[2:]
    assert read("traffic", "bins") == []
    with pytest.raises(ValueError, match="other"):
        mapped_tables(read_ingestion_mapping(spark, ingestion_file, "other"), "other")


def test_metric_mapping_matches_exact_source(spark, tmp_path):
    path = tmp_path / "metrics.txt"
    lines = [("crm_visits", "visits", "crm", "lake", "web", "hourly"), ("wms_bins", "bins", "wms", "lake", "", "hourly"),
             ("wms_bins", "bins", "wms", "vault", "stock", "weekly")]
    path.write_text("\n".join("|".join(line) for line in [METRIC_MAPPING.names, *lines]) + "\n")
    read = lambda *wanted: rows(read_metric_mapping(spark, str(path), *wanted))
    assert read("hourly") == lines[:2] and read() == lines and read("yearly") == []
    assert read("hourly", "wms_bins") == [lines[1]] and read(None, "wms_bins") == lines[1:]
    assert read("hourly", "WMS_BINS") == []


def test_run_variables():
    assert run_variables("2023-01-31") == {
        "as_of_date": "2023-01-31",
        "next_ingest_date": "2023-02-01 09:00:00",
        "prev_ingest_date": "2023-01-30",
    }
    assert as_date("20230131") == as_date("2023-01-31") == as_date(dt.datetime(2023, 1, 31, 5))


def test_stored_query(spark, tmp_path):
    (tmp_path / "visits.hql").write_text(
        "SELECT ${as_of_date} AS a, -- the day\n  ${next_ingest_date} AS n, :prev_ingest_date AS p, 'a''b' AS q;\n")
    found = run_stored_query(spark, str(tmp_path), "Visits", "2023-01-10")
    assert rows(found) == [("2023-01-10", "2023-01-11 09:00:00", "2023-01-09", "a'b")]


@pytest.mark.parametrize("text, told", [
    ("SELECT '${as_of_date}'", "inside quotes"), ('SELECT "day ${as_of_date}"', "inside quotes"),
    ("SELECT 1 WHERE d LIKE '%${prev_ingest_date}'", "inside quotes"), ("SELECT ${run_date}", "run_date"),
    ("SELECT ${}", "unknown"),
    ("-- don't touch\nSELECT 1 WHERE d = '${as_of_date}'", "inside quotes"),
    ("/* it's */ SELECT 1 WHERE d = '${as_of_date}'", "inside quotes"),
    ("SELECT `${as_of_date}` FROM t", "inside quotes"), ("SELECT r'\\${as_of_date}'", "inside quotes"),
    ("SELECT 'it\\'s ${as_of_date}'", "inside quotes"), ("SELECT 'it''s ${as_of_date}'", "inside quotes"),
    ("SELECT '-- ${as_of_date}'", "inside quotes"), ("SELECT /*+ ${as_of_date} */ 1", "inside quotes"),
    ("SELECT 'open ${as_of_date}", "inside quotes"), ("SELECT 1 /* open ${as_of_date}", "not closed"),
    ("SELECT 1 /* a /* b */ ${as_of_date}", "not closed"),
])
def test_stored_query_refuses_what_it_cannot_fill(spark, tmp_path, text, told):
    (tmp_path / "t.hql").write_text(text)
    with pytest.raises(ValueError, match=told):
        run_stored_query(spark, str(tmp_path), "t", "2023-01-10")


@pytest.mark.parametrize(("text", "wanted"), [
    ("-- don't touch ${nobody}\nSELECT ${as_of_date} AS d", "2023-01-10"),
    ("/* it's ${nobody} */ SELECT ${as_of_date} AS d /* 'tis done */;\n-- ; ${x}", "2023-01-10"),
    ("SELECT /* a /* nested ' */ ` */ ${as_of_date} AS d", "2023-01-10"),
    ("SELECT concat('--', ${as_of_date}, '/*') AS d -- '", "--2023-01-10/*"),
    ("SELECT concat('it\\'s ', ${as_of_date}) AS d", "it's 2023-01-10"),
    ("SELECT concat(r'\\', ${as_of_date}) AS d", "\\2023-01-10"),
    ("SELECT concat(\"'\", ${as_of_date}) AS `the ' day`", "'2023-01-10"),
    ("SELECT /*+ REPARTITION(2) */ ${as_of_date} AS d", "2023-01-10"),
    ("-- goes on \\\n ' here\nSELECT ${as_of_date} AS d", "2023-01-10"),
])
def test_stored_query_knows_comments_and_quotes(spark, tmp_path, text, wanted):
    (tmp_path / "t.hql").write_text(text)
    assert rows(run_stored_query(spark, str(tmp_path), "t", "2023-01-10")) == [(wanted,)]


@pytest.mark.parametrize("names", [(), ("a", "b")])
def test_stored_query_is_one_file(spark, tmp_path, names):
    (tmp_path / "t.hql").mkdir()
    for name in names:
        (tmp_path / "t.hql" / name).write_text("SELECT 1")
    with pytest.raises(ValueError, match="one file"):
        run_stored_query(spark, str(tmp_path), "t", "2023-01-10")


def test_ingest_and_rerun(spark, root, ingestion_file):
    for _ in range(2):
        counts = ingest_domain(
            spark, read_ingestion_mapping(spark, ingestion_file, "traffic"),
            lambda target: spark.range(7).withColumn("t", F.lit(target)),
            root, "traffic", D3, RUN_TS, files=2,
        )
    ingest_domain(
        spark, read_ingestion_mapping(spark, ingestion_file, "storage"),
        lambda target: spark.range(7).where("id > 10"), root, "storage", D3, RUN_TS,
    )
    lake, vault = (spark.read.schema(TRANSFORM_COUNTS).parquet(f"{root}/{db}/metrics/transform_counts")
                   for db in ("lake", "vault"))
    stored = lake.unionByName(vault)
    assert counts.schema.names == stored.schema.names == TRANSFORM_COUNTS.names
    moment = dt.datetime(2023, 1, 11, 6)

    def line(source, table, database, size, name):
        return (source, table, size, 0, 0, 0, database, size, size, 0, 0, 0, 0, 0, moment, " ", D3, name)

    assert rows(stored) == sorted([
        line("crm", "crm_visits", "lake", 7, "Visits"), line("crm", "crm_visits_old", "vault", 7, "Visits"),
        line("wms", "wms_bins", "lake", 0, "bins")])
    data = spark.read.parquet(f"{root}/vault/web/Visits")
    assert rows(data.groupBy("as_of_date", "t").count()) == [(D3, "Visits", 7)]


def test_many_tables_side_by_side(spark, root):
    names = [f"t{i}" for i in range(9)]
    mapping = spark.createDataFrame(
        [(f"{n}_src", n, "F", "up", "lake", "d") for n in names], INGESTION_MAPPING)
    counts = ingest_domain(
        spark, mapping, lambda target: spark.range(int(target[1:])), root, "d", D3, RUN_TS)
    assert rows(counts, "dest_tbl", "src_count", "dest_count") == [(n, i, i) for i, n in enumerate(names)]

    def broken(target):
        return spark.table("no_such_table") if target == "t3" else spark.range(20)

    with pytest.raises(IngestionError, match="lake.t3") as caught:
        ingest_domain(spark, mapping, broken, root, "d", D3, RUN_TS)
    assert set(caught.value.failed) == {"lake.t3"}
    # The others are done and recorded; the failed one keeps its snapshot and its row.
    stored = spark.read.schema(TRANSFORM_COUNTS).parquet(f"{root}/lake/metrics/transform_counts")
    assert rows(stored, "dest_tbl", "src_count") == [(n, 3 if n == "t3" else 20) for n in names]
    assert spark.read.parquet(f"{root}/lake/F/t3").count() == 3
    assert spark.read.parquet(f"{root}/lake/F/t4").count() == 20


def test_targets_mapped_twice_are_refused(spark, root, tmp_path):
    mapping = spark.createDataFrame(
        [("a", "t", "F", "up", "lake", "d"), ("b", "t", "F", "up", "lake", "d")], INGESTION_MAPPING)
    with pytest.raises(ValueError, match="lake.F.t"):
        ingest_domain(spark, mapping, lambda target: spark.range(1), root, "d", D3, RUN_TS)
    assert not (tmp_path / "lake").exists()


@pytest.mark.parametrize("key_type", ["DATE", "STRING"])
def test_ingest_into_a_catalog_table(spark, root, ingestion_file, key_type):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lake LOCATION '{root}/catalog'")
    spark.sql(
        f"CREATE TABLE lake.bins (id BIGINT, as_of_date {key_type}) USING parquet "
        f"PARTITIONED BY (as_of_date) LOCATION '{root}/lake/stock/now/bins'"
    )
    mapping = read_ingestion_mapping(spark, ingestion_file, "storage")
    for day, size in ((D1, 7), (D3, 3), (D3, 5)):
        counts = ingest_domain(
            spark, mapping, lambda target: spark.range(size), root, "storage", day, RUN_TS,
            register=True,
        )
        assert rows(counts, "src_count", "dest_count") == [(size, size)]
    table = spark.table("lake.bins")
    assert rows(stored_counts(table, "lake", "t")) == [("lake", "t", D1, 7), ("lake", "t", D3, 5)]
    assert previous_snapshot_dates({"t": table}, D3) == {"t": D1}
    checked = null_check(
        table, [QualityRule("t", ("id",))], table="t", source_type="lake", run_ts=RUN_TS, as_of=D3)
    assert rows(checked, "as_of_date", "null_count") == [(D3, 0)]
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(as_of_date" in plan and "cast(as_of_date" not in plan
    spark.sql("DROP TABLE lake.bins")
    spark.sql("DROP DATABASE lake")


def history(spark, *days):
    data = [(1, day) for day in days for _ in range(2)]
    return spark.createDataFrame(data, "id int, as_of_date date")


def test_previous_snapshot(spark):
    df = history(spark, D1, D3)
    assert rows(previous_snapshot(df, D3)) == [(D3, D1)]
    assert rows(previous_snapshot(df, D2)) == [(D2, D1)]
    assert rows(previous_snapshot(df, D1)) == [(D1, None)]
    named = df.withColumns({"dest_db": F.lit("d"), "dest_tbl": F.lit("t")})
    assert rows(previous_snapshots(named)) == [("d", "t", D1, None), ("d", "t", D3, D1)]


@pytest.mark.parametrize("gap", [1, 2, 7, 8, 100, 101, 4000])
def test_previous_date_however_long_ago(spark, gap):
    df = history(spark, D3, D3 - dt.timedelta(days=gap))
    assert previous_snapshot_dates({"t": df}, D3) == {"t": D3 - dt.timedelta(days=gap)}
    assert previous_snapshot_dates({"t": df}, D3 - dt.timedelta(days=gap)) == {"t": None}


def stored_history(spark, root, *days, name="t"):
    path = f"{root}/{name}"
    for day in days:
        replace_snapshot(spark.range(2), path, day)
    return path


def days_read(spark, call):
    """What a call returns, and the dates whose files it opened."""
    opened = set()
    real = spark.read.__class__.parquet

    def parquet(self, *paths, **options):
        opened.update(path.rpartition("=")[2] for path in paths if "as_of_date=" in path)
        return real(self, *paths, **options)

    spark.read.__class__.parquet = parquet
    try:
        return call(), opened
    finally:
        spark.read.__class__.parquet = real


def test_previous_stored_date_opens_no_older_file(spark, root):
    days = [D3 - dt.timedelta(days=n) for n in (0, 1, 2, 200, 1000)]
    path = stored_history(spark, root, *days)
    (found, opened) = days_read(spark, lambda: previous_stored_dates(spark, {"t": path}, D3))
    assert found == {"t": days[1]} and opened == {str(days[1])}
    # Emptied partitions are passed over: one has no file left, one a file without a row.
    replace_snapshot(spark.range(0), path, days[1])
    spark.range(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/as_of_date={days[2]}")
    (found, opened) = days_read(spark, lambda: previous_stored_dates(spark, {"t": path}, D3))
    assert found == {"t": days[3]} and opened == {str(days[2]), str(days[3])}
    assert stored_days(spark, path, days[3]) == [days[4]]


def test_previous_stored_dates_of_many_tables(spark, root):
    paths = {n: stored_history(spark, root, D1, D2, name=f"t{n}") for n in range(3)}
    paths["none"] = f"{root}/never"
    assert previous_stored_dates(spark, paths, D2) == {0: D1, 1: D1, 2: D1, "none": None}
    assert previous_stored_dates(spark, paths, D1) == dict.fromkeys(paths)


def test_previous_date_from_a_catalog(spark):
    spark.sql("DROP TABLE IF EXISTS listed_dates")
    spark.sql("CREATE TABLE listed_dates (id long, region string, as_of_date date) USING parquet "
              "PARTITIONED BY (as_of_date, region)")
    for day in (D1, D2):
        spark.sql(f"INSERT INTO listed_dates VALUES (1, DATE '{day}', 'x'), (1, DATE '{day}', 'y'), (1, NULL, 'z')")
    spark.sql(f"ALTER TABLE listed_dates ADD PARTITION (as_of_date = '{D3}', region = 'x')")
    later = D3 + dt.timedelta(days=1)
    assert stored_days(spark, "listed_dates", later) == [D3, D2, D1]
    assert previous_stored_dates(spark, {"t": "listed_dates"}, later) == {"t": D2}
    assert previous_stored_dates(spark, {"t": "default.listed_dates"}, D2) == {"t": D1}
    spark.sql("DROP TABLE listed_dates")


def test_previous_dates_of_many_tables_take_two_jobs(spark):
    tables = {("db", n): history(spark, D3, D3 - dt.timedelta(days=30 * n)) for n in range(1, 9)}
    spark.sparkContext.setJobGroup("previous dates", "")
    found = previous_snapshot_dates(tables, D3)
    tracker = spark.sparkContext.statusTracker()
    jobs = len(tracker.getJobIdsForGroup("previous dates"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {("db", n): D3 - dt.timedelta(days=30 * n) for n in range(1, 9)}
    assert jobs <= 2 * 9  # stages of one union each, run together
    assert previous_snapshot_dates({}, D3) == {}


TARGET_DATE = "dest_db string, dest_tbl string, as_of_date date"


def counts_of(spark, *keys, stored_only=()):
    named = {k[:2] for k in (*keys, *stored_only)}
    mapping = spark.createDataFrame(
        [(f"{t}_of_{db}", t, "F", "up", db, "d") for db, t in named], INGESTION_MAPPING)
    produced = spark.createDataFrame([(*k, 5) for k in keys], f"{TARGET_DATE}, src_count long")
    stored = spark.createDataFrame(
        [(*k, 4) for k in (*keys, *stored_only) if k[2] != D2], f"{TARGET_DATE}, dest_count long")
    return transform_counts(produced, stored, mapping, RUN_TS)


def test_counts_differ_where_rows_are_missing(spark):
    found = counts_of(spark, ("x", "a", D1), ("x", "a", D2), stored_only=[("x", "a", D3)])
    assert rows(found, "as_of_date", "src_count", "dest_count", "dest_add") == [
        (D1, 5, 4, 4), (D2, 5, 0, 0), (D3, 0, 4, 4)]


def test_one_name_in_two_databases(spark):
    found = counts_of(spark, ("x", "a", D1), ("y", "a", D1), ("x", "b", D1))
    assert rows(found, "dest_db", "dest_tbl", "src_tbl") == [
        ("x", "a", "a_of_x"), ("x", "b", "b_of_x"), ("y", "a", "a_of_y")]


def test_unmapped_tables_are_refused(spark):
    produced = spark.createDataFrame([("x", "lost", D1, 5)], f"{TARGET_DATE}, src_count long")
    stored = spark.createDataFrame([], f"{TARGET_DATE}, dest_count long")
    mapping = spark.createDataFrame([("s", "lost", "F", "up", "y", "d")], INGESTION_MAPPING)
    with pytest.raises(PySparkException, match="x.lost"):
        transform_counts(produced, stored, mapping, RUN_TS).collect()


def test_stored_counts_of_every_date(spark):
    assert rows(stored_counts(history(spark, D1, D3), "x", "t")) == [("x", "t", D1, 2), ("x", "t", D3, 2)]


def test_counts_replace_only_their_partition(spark, root):
    write_transform_counts(counts_of(spark, ("x", "a", D1), ("x", "b", D1)), root, [D1], ["a", "b"])
    write_transform_counts(counts_of(spark, ("x", "a", D1)), root, [D1], ["a"])
    write_transform_counts(counts_of(spark, ("x", "a", D2)), root, [D2], ["a"])
    stored = spark.read.schema(TRANSFORM_COUNTS).parquet(root)
    assert rows(stored, "as_of_date", "dest_tbl") == [(D1, "a"), (D1, "b"), (D2, "a")]


def test_report(spark, root, tmp_path):
    counts = counts_of(spark, ("x", "a", D3), ("y", "a", D3), ("x", "c", D3), ("x", "a", D1))
    mapping = spark.createDataFrame(
        [("a_of_x", "a", "up", "x", "F", "n"), ("a_of_y", "a", "up", "y", "F", "n")], METRIC_MAPPING)
    snapshots = {("x", "a"): history(spark, D1, D3), ("y", "a"): history(spark, D3)}
    path = report_batch(counts, snapshots, mapping, root, "hourly", D3)
    assert path == f"{root}/as_of_date=2023-01-10/hourly"
    files = list((tmp_path / "lake").rglob("part-*"))
    assert len([f for f in files if f.suffix == ".csv"]) == 1
    line = "2023-01-10|up|a_of_{d}|5|0|0|0|{d}|a|4|4|0|0|0|0|0|2023-01-11 06:00:00|0|4|{y}|4"
    assert rows(spark.read.text(path)) == [
        (line.format(d="x", y="2023-01-08"),), (line.format(d="y", y="NULL"),)]


def test_report_columns(spark):
    previous = spark.createDataFrame([], f"{TARGET_DATE}, yest_ingest_dt date")
    mapping = spark.createDataFrame([("a_of_x", "a", "up", "x", "F", "n")] * 2, METRIC_MAPPING)
    report = metrics_export(counts_of(spark, ("x", "a", D1)), previous, mapping)
    assert tuple(report.columns) == EXPORT_COLUMNS and len(EXPORT_COLUMNS) == 21
    assert report.count() == 1


def errors(spark, *details):
    moment = dt.datetime(2023, 1, 11, 6)
    return spark.createDataFrame(
        [("lake", "DUP_ERROR:k", 2, detail, moment, D3, "t") for detail in details], SQL_ERRORS)


def test_error_lines(spark):
    found = error_lines(errors(spark, "a,b", "tab\there", None), "2000").select("value")
    head, tail = "2023-01-10|INFO|2000|lake|t|DUP_ERROR:k|2|", "|2023-01-11 06:00:00"
    assert rows(found) == sorted([(head + d + tail,) for d in ("NULL", "a,b", "tab|here")])
    assert error_code("account") == "2003" and error_code("transaction") == "2000"
    with pytest.raises(ValueError, match="other"):
        error_code("other")


def test_error_export_is_not_repeated(spark, root):
    for details in (("a", "b"), ("c",), ("c",)):
        export_errors(errors(spark, *details), root, [D3], "transaction", ["t", "u"])
    assert export_errors(errors(spark, "x"), root, [D2], "transaction", ["t"]) == 0
    assert export_errors(errors(spark, "x"), root, [D3], "account", ["u"]) == 0
    with pytest.raises(ValueError, match="third"):
        export_errors(errors(spark, "x"), root, [D3], "third", ["t"])
    lines = [row.value for row in spark.read.text(root).collect()]
    assert lines == ["2023-01-10|INFO|2000|lake|t|DUP_ERROR:k|2|c|2023-01-11 06:00:00"]


LOG = ["an Error here", "ERROR: shouted", "NOTE: then Exception", "plain", "WARN Error", ""]


def test_a_domain_may_bring_its_code(spark, root):
    assert export_errors(errors(spark, "c"), root, [D3], "third", ["t"], code="9001") == 1
    assert spark.read.text(root).first().value.startswith("2023-01-10|INFO|9001|lake|t|")


def test_log_lines(spark, root):
    log = spark.createDataFrame([(line,) for line in LOG], "value string")
    found = classify_log(log, D3, "account", "data_ingestion")
    head = "2023-01-10|INFO|99|account|account_data_ingestion|"
    assert rows(found) == sorted([
        (head + "ERROR|an Error here",), (head + "Exception|NOTE: then Exception",),
        (head + "NOTE|NOTE: then Exception",), (head + "ERROR|WARN Error",),
        (head + "WARN|WARN Error",),
    ])
    upper = classify_log(log, D3, "account", "dq_check", upper_domain=True)
    assert rows(upper)[0][0].startswith("2023-01-10|INFO|99|ACCOUNT|account_dq_check|ERROR|")
    for _ in range(2):
        assert write_lines(found, root, D3, "job", "data_ingestion") == 5
    assert spark.read.text(root).count() == 5
    own = classify_log(log, D3, "account", "x", levels={"plain": "P"})
    assert rows(own) == [("2023-01-10|INFO|99|account|account_x|P|plain",)]


def session_like(folder, master):
    conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_path(spark):
    cluster = session_like("hdfs:///shared/", "yarn")
    assert shared_path(cluster, "x").startswith("hdfs:///shared/x-")
    assert shared_path(cluster, "x") != shared_path(cluster, "x")
    assert "/x-" in shared_path(session_like(None, "local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(session_like(None, "yarn"), "x")
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_path(spark, "x").startswith(named)


def printed(df):
    return df.agg(rows_print(df).alias("p")).first().p


def test_prints_tell_rows_apart_in_any_order(spark):
    data = [(1, "a", None, -0.0), (1, "a", None, 0.0), (2, None, "a", float("nan")), (3, "", "b", 1.5)]
    fields = "id long, `x.y` string, z string, w double"
    df = spark.createDataFrame(data, fields)
    assert printed(df) == printed(spark.createDataFrame(data[::-1], fields).repartition(3))
    assert printed(df) == printed(df.select("w", "z", "`x.y`", "id").withColumn("as_of_date", F.lit("x")))
    assert printed(df.where("false")) == 0
    others = [
        data[:3], [*data, data[0]], [*data[:3], (3, "b", "", 1.5)], [*data[1:], (1, None, "a", -0.0)],
        [*data[1:], (1, "a", "", 0.0)], [(n + 1, *rest) for n, *rest in data]]
    sums = [printed(spark.createDataFrame(other, fields)) for other in others]
    assert len({printed(df), *sums}) == len(others) + 1


def test_a_swapped_row_is_told(spark, root, ingestion_file):
    mapping = read_ingestion_mapping(spark, ingestion_file, "storage")

    def run():
        return ingest_domain(spark, mapping, lambda target: spark.range(7).withColumn("v", F.col("id") % 2),
                             root, "storage", D3, RUN_TS, compare_rows=True)

    assert rows(run(), "dest_tbl", "src_count", "dest_count", "error_msg") == [("bins", 7, 7, " ")]
    path = f"{root}/lake/stock/now/bins"
    made = replace_snapshot(spark.range(7), path, D3, also={"p": rows_print(spark.range(7))})
    assert made["rows"] == 7 and made["p"] == printed(spark.range(7))
    produced = spark.createDataFrame([("lake", "bins", D3, 7, made["p"]), ("lake", "bins", D1, 0, Decimal(0))],
                                     f"{TARGET_DATE}, src_count long, src_print decimal(38,0)")
    for swapped, told in ((0, " "), (1, "stored rows differ from the rows produced")):
        replace_snapshot(spark.range(swapped, 7 + swapped), path, D3)
        stored = stored_counts(spark.read.parquet(path), "lake", "bins", prints=True)
        counts = transform_counts(produced, stored, mapping, RUN_TS)
        assert rows(counts, "as_of_date", "src_count", "dest_count", "error_msg") == [(D1, 0, 0, " "), (D3, 7, 7, told)]


def test_repeated_tasks_print_once(spark, root):
    """A task that fails once and is repeated has its rows counted and printed once."""
    def once(batches):
        for batch in batches:
            if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
                raise OSError("lost")
            yield batch

    df = spark.range(100).repartition(4)
    shaky = df.mapInPandas(once, "id long")
    made = replace_snapshot(shaky, root, D1, also={"p": rows_print(shaky)})
    assert (made["rows"], made["p"]) == (100, printed(df))

"""The commands one after the other on one lake."""

import json

import pytest

from conftest import rows
from tidemark.jobs import main
from tidemark.schemas import INGESTION_MAPPING, METRIC_MAPPING, RULE_MAPPING, SQL_ERRORS, STATUS

DAYS = ("2023-01-09", "2023-01-10")


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    spark.sql(f"CREATE DATABASE jobs_lake LOCATION '{tmp_path}/catalog'")
    spark.sql(
        "CREATE TABLE jobs_lake.meters (id BIGINT, account_type STRING, name STRING, "
        "as_of_date DATE) USING parquet PARTITIONED BY (as_of_date) "
        f"LOCATION '{root}/jobs_lake/raw/meters/meters'"
    )
    for name, schema, line in (
        ("ingestion", INGESTION_MAPPING, "feed|meters|raw/meters|plant|jobs_lake|energy"),
        ("rules", RULE_MAPPING, "meters|name|account_type|energy|ConditionalNullsNonVBO"),
        ("metrics", METRIC_MAPPING, "feed|meters|plant|jobs_lake|raw/meters|nightly"),
    ):
        (tmp_path / name).write_text("|".join(schema.names) + "\n" + line + "\n")
    (tmp_path / "meters.hql").write_text(
        "SELECT * FROM VALUES (1L, 'VBA', ''), (2L, 'VBA', ${as_of_date}), (3L, 'VBO', NULL) "
        "AS t(id, account_type, name)"
    )
    yield tmp_path
    spark.sql("DROP TABLE jobs_lake.meters")
    spark.sql("DROP DATABASE jobs_lake")


def run(job, lake, day, *more):
    return main([job, "--as-of", day, "--root", f"{lake}/lake", *more])


def test_ingest_check_and_report(spark, lake):
    stamp = ("--run-ts", "2023-01-11 06:00:00")
    for day in DAYS:
        assert run("ingest", lake, day, "--mapping", f"{lake}/ingestion", "--queries", str(lake),
                   "--domain", "energy", "--files", "1", "--register", *stamp) == 0
        assert run("quality", lake, day, "--mapping", f"{lake}/rules", "--database", "jobs_lake",
                   "--domain", "energy", "--out", f"{lake}/errors", "--code", "3100", *stamp) == 0
    assert spark.table("jobs_lake.meters").count() == 6
    errors = spark.read.schema(SQL_ERRORS).parquet(f"{lake}/lake/jobs_lake/metrics/sql_errors")
    assert rows(errors, "error_type", "null_count") == sorted(
        [("DUP_ERROR:account_type", 2), ("NULL_VALUES", 1)] * 2)
    lines = [row.value for row in spark.read.text(f"{lake}/errors").collect()]
    assert len(lines) == 4 and all("|INFO|3100|jobs_lake|meters|" in line for line in lines)
    assert run("metrics", lake, DAYS[1], "--mapping", f"{lake}/metrics",
               "--batch", "nightly", "--out", f"{lake}/report") == 0
    assert rows(spark.read.text(f"{lake}/report/as_of_date=2023-01-10/nightly")) == [(
        "2023-01-10|plant|feed|3|0|0|0|jobs_lake|meters|3|3|0|0|0|0|0|2023-01-11 06:00:00|0|3"
        "|2023-01-09|3",
    )]
    assert run("metrics", lake, DAYS[1], "--mapping", f"{lake}/metrics",
               "--batch", "other", "--out", f"{lake}/report") == 0
    assert not (lake / "report" / "as_of_date=2023-01-10" / "other").exists()
    # The code is asked for before anything is checked or written.
    with pytest.raises(ValueError, match="energy"):
        run("quality", lake, "2023-01-11", "--mapping", f"{lake}/rules", "--database", "jobs_lake",
            "--domain", "energy", "--out", f"{lake}/errors")
    assert errors.where("as_of_date = '2023-01-11'").count() == 0
    with pytest.raises(ValueError, match="other"):
        run("ingest", lake, DAYS[0], "--mapping", f"{lake}/ingestion", "--queries", str(lake),
            "--domain", "other")
    with pytest.raises(SystemExit):
        run("ingest", lake, "2023-13-01")


@pytest.mark.parametrize("times, now, code", [
    (("2023-01-10T08:00:00",), "2023-01-10 12:00:00", 0),
    (("2023-01-10T08:00:00", "NA"), "2023-01-10 12:00:00", 2),
    (("2023-01-10T08:00:00",), "2023-01-10 18:00:00", 1),
])
def test_freshness(spark, tmp_path, times, now, code):
    records = [
        {**dict.fromkeys(STATUS.names, "NA"), "lastSuccess": time, "domain": "energy", "table": f"t{i}"}
        for i, time in enumerate(times)
    ]
    (tmp_path / "status.json").write_text("\n".join(map(json.dumps, records)))
    assert main([
        "freshness", "--as-of", "2023-01-10", "--root", f"{tmp_path}/lake", "--database", "lake",
        "--status", f"{tmp_path}/status.json", "--domain", "energy", "--out", f"{tmp_path}/lists",
        "--now", now,
    ]) == code
    published = tmp_path / "lake" / "lake" / "metrics" / "table_status"
    assert published.exists() == (code == 0)


def test_log(spark, tmp_path):
    (tmp_path / "job.log").write_text("fine\nNOTE: one\nError and WARN\n")
    for _ in range(2):
        main(["log", "--as-of", "2023-01-10", "--domain", "account", "--job", "dq_check",
              "--upper-domain", "--out", f"{tmp_path}/out", f"{tmp_path}/job.log"])
    head = "2023-01-10|INFO|99|ACCOUNT|account_dq_check|"
    assert rows(spark.read.text(f"{tmp_path}/out").select("value")) == sorted([
        (head + "NOTE|NOTE: one",), (head + "ERROR|Error and WARN",), (head + "WARN|Error and WARN",)])


def test_quality_on_an_empty_lake(spark, tmp_path):
    (tmp_path / "rules").write_text("|".join(RULE_MAPPING.names) + "\nt|None|None|account|None\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS fresh_lake")
    spark.sql("CREATE TABLE fresh_lake.t (id BIGINT, as_of_date DATE) USING parquet")
    try:
        assert main(["quality", "--as-of", "2023-01-10", "--root", f"{tmp_path}/lake", "--mapping",
                     f"{tmp_path}/rules", "--database", "fresh_lake", "--domain", "account",
                     "--out", f"{tmp_path}/out"]) == 0
    finally:
        spark.sql("DROP DATABASE fresh_lake CASCADE")


def test_report_over_several_databases(spark, tmp_path):
    """Tables of one name in two databases, both in the report of one batch."""
    for database in ("first_lake", "second_lake"):
        spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/{database}'")
        spark.sql(
            f"CREATE TABLE {database}.t (id BIGINT, as_of_date DATE) USING parquet PARTITIONED BY (as_of_date) "
            f"LOCATION '{tmp_path}/lake/{database}/f/t'")
    try:
        (tmp_path / "ingestion").write_text("\n".join([
            "|".join(INGESTION_MAPPING.names), "s1|t|f|up|first_lake|d", "s2|t|f|up|second_lake|d"]) + "\n")
        (tmp_path / "metrics").write_text("\n".join([
            "|".join(METRIC_MAPPING.names), "s1|t|up|first_lake|f|n", "s2|t|up|second_lake|f|n"]) + "\n")
        (tmp_path / "t.hql").write_text("SELECT id FROM RANGE(5)")
        common = ["--as-of", "2023-01-10", "--root", f"{tmp_path}/lake"]
        assert main(["ingest", *common, "--mapping", f"{tmp_path}/ingestion", "--queries", str(tmp_path),
                     "--domain", "d", "--register"]) == 0
        assert main(["metrics", *common, "--mapping", f"{tmp_path}/metrics", "--batch", "n",
                     "--out", f"{tmp_path}/report"]) == 0
        lines = [r.value.split("|") for r in spark.read.text(f"{tmp_path}/report/as_of_date=2023-01-10/n").collect()]
        assert sorted((x[2], x[7], x[8], x[9]) for x in lines) == [
            ("s1", "first_lake", "t", "5"), ("s2", "second_lake", "t", "5")]
    finally:
        for database in ("first_lake", "second_lake"):
            spark.sql(f"DROP DATABASE {database} CASCADE")

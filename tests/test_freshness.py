import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from tidemark.operators import classify_freshness, readiness, status_summary
from tidemark.plans import check_domain, check_domains, publish_status
from tidemark.schemas import STATUS
from tidemark.sources import expand_tables, poll_defaults, read_documents, status_records
from tidemark.streaming import await_verdict, watch_domain
from workload.tables import status_events


def record(success, no_change="NA", failure="NA"):
    return {
        "lastUpdated": success, "latestStatus": "SUCCESS", "appPrefix": "XY", "pipeline": "night",
        "lastSuccess": success, "lastFailure": failure, "lastNoChange": no_change,
        "lastMaintenance": "NA", "as_of_date": "NA", "other": "NA",
    }


DAY, NEXT, BEFORE = "2022-07-18", "2022-07-19", "2022-07-17"
# Three databases; times at the first and last moment of the day and of its neighbours.
RESPONSE = {
    "sales.invoices": record(f"{DAY}T00:00:00"),
    "sales.refunds": record("NA", no_change=f"{DAY}T23:59:59.999999"),
    "stock.bins": record(f"{BEFORE}T23:59:59.999999", failure=f"{DAY}T12:00:00"),
    "stock.moves": record("2022-07-02T04:00:00", no_change=f"{NEXT}T00:00:00"),
    "geo.sites": record("NA"),
}
FRESH, STALE = ["sales.invoices", "sales.refunds"], ["geo.sites", "stock.bins", "stock.moves"]


def status(spark, response=RESPONSE, domain="trade"):
    lines = spark.createDataFrame([(json.dumps(response),)], "value string")
    return status_records(lines, domain)


def fresh_tables(spark, as_of, response=RESPONSE):
    judged = classify_freshness(status(spark, response), as_of)
    return [row[0] for row in rows(judged.where("is_fresh"), "table")]


@pytest.mark.parametrize("as_of, expected", [
    (DAY, FRESH), (BEFORE, ["stock.bins"]), (NEXT, ["stock.moves"]), ("2022-07-20", []),
])
def test_fresh_tables(spark, as_of, expected):
    assert fresh_tables(spark, as_of) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_date_is_the_one_written(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        response = {
            "a": record("2022-07-05T23:59:59.999999"), "b": record("2022-07-05T00:00:00"),
            "c": record("2022-07-05T23:30:00Z"), "d": record("2022-07-05 00:30:00+09:00"),
            "e": record("2022-07-05"), "f": record("2022-07-06T00:00:00"),
        }
        assert fresh_tables(spark, "2022-07-05", response) == ["a", "b", "c", "d", "e"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_absent_malformed_and_failed(spark):
    response = {
        "absent": record("NA"), "malformed": record("yesterday"),
        "failed later": record("2022-07-05T08:00:00", failure="2022-07-05T09:00:00"),
        "unchanged": record("NA", no_change="2022-07-05T08:00:00"),
    }
    assert fresh_tables(spark, "2022-07-05", response) == ["failed later", "unchanged"]


def test_other_forms_of_a_time(spark):
    response = {
        "basic": record("20220718T080000"), "day first": record("7/18/2022 08:00"),
        "date": record("07/18/2022"), "dots": record("2022-07-18T08.00.00.125"),
        "basic date": record("20220718"), "other day": record("20220719T000000"),
    }
    assert fresh_tables(spark, DAY, response) == ["basic", "basic date", "date", "day first", "dots"]


def test_every_record_is_fresh_or_stale(spark):
    judged = classify_freshness(status(spark), DAY)
    assert judged.where(F.col("is_fresh").isNull()).count() == 0
    assert judged.columns == [*STATUS.names, "is_fresh"] and judged.count() == 5


# 11:59 Eastern is 16:59 UTC in December and 15:59 in July.
@pytest.mark.parametrize("now, stale, expected", [
    ("2021-12-05 16:58:59", True, "WAIT"), ("2021-12-05 16:58:59", False, "READY"),
    ("2021-12-05 16:59:00", True, "FAILED"), ("2021-12-05 16:59:00", False, "FAILED"),
    ("2021-07-05 15:58:59.999", True, "WAIT"), ("2021-07-05 15:59:00", False, "FAILED"),
    ("2021-07-05 15:58:59", False, "READY"), (dt.datetime(2021, 7, 5, 23, 0), False, "FAILED"),
])
def test_verdict(spark, root, now, stale, expected):
    response = RESPONSE if stale else {t: RESPONSE[t] for t in FRESH}
    one = readiness(classify_freshness(status(spark, response), DAY), now).first()
    assert (one.verdict, one.n_stale, one.n_tables) == (expected, 3 if stale else 0, 5 if stale else 2)
    assert check_domain(status(spark, response), root, "trade", DAY, now) == expected


def listed(spark, root, name):
    return [row[0] for row in rows(spark.read.schema(STATUS).json(f"{root}/{name}"), "table")]


def test_lists_follow_the_verdict(spark, root):
    early, late = f"{DAY} 14:00:00", f"{DAY} 20:00:00"
    ready = {t: RESPONSE[t] for t in FRESH}
    assert check_domain(status(spark), root, "trade", DAY, early) == "WAIT"
    assert listed(spark, root, "failed") == STALE
    assert check_domain(status(spark, ready), root, "trade", DAY, early) == "READY"
    assert listed(spark, root, "ready") == FRESH
    assert listed(spark, root, "failed") == STALE
    # Too late with nothing stale: an empty list replaces the old one.
    assert check_domain(status(spark, ready), root, "trade", DAY, late) == "FAILED"
    assert listed(spark, root, "failed") == []


def test_all_domains_at_once(spark, root):
    ready = status(spark, {t: RESPONSE[t] for t in FRESH}, "calm")
    both = status(spark).unionByName(ready)
    assert check_domains(both, root, DAY, f"{DAY} 14:00:00") == {"trade": "WAIT", "calm": "READY"}
    assert listed(spark, root, "failed") == STALE and listed(spark, root, "ready") == FRESH
    assert check_domains(both, root, DAY, f"{DAY} 20:00:00") == {"trade": "FAILED", "calm": "FAILED"}
    assert listed(spark, root, "failed") == STALE and listed(spark, root, "ready") == FRESH
    assert check_domains(both.where("false"), root, DAY, f"{DAY} 20:00:00") == {}


def test_domain_without_records_has_nothing_stale(spark, root):
    assert check_domain(status(spark), root, "none", DAY, f"{DAY} 14:00:00") == "READY"


def test_publish_replaces_one_domain_in_one_file(spark, root, tmp_path):
    for _ in range(2):
        assert publish_status(status(spark), root, DAY, "trade") == 2
    publish_status(status(spark, domain="other"), root, DAY, "other")
    assert publish_status(status(spark), root, DAY, "trade") == 2
    stored = spark.read.parquet(root)
    expected = [(domain, t) for domain in ("other", "trade") for t in FRESH]
    assert rows(stored, "dest_tbl", "table") == expected
    assert len(list((tmp_path / "lake").rglob("*.parquet"))) == 2


def test_publish_all_domains(spark, root):
    both = status(spark).unionByName(status(spark, domain="other"))
    assert publish_status(both, root, DAY) == 4
    assert publish_status(status(spark, domain="other"), root, NEXT) == 1
    stored = spark.read.parquet(root)
    assert rows(stored.groupBy("dest_tbl").count()) == [("other", 3), ("trade", 2)]
    assert publish_status(both.where("false"), root, DAY) == 0


LIST = {
    "defaults": {"action": "ask", "jarPath": "/lib/poll.jar", "messageType": "state",
                 "subject": "tables", "app_prefix": "XY", "pipeline": "night"},
    "sales": {"app_prefix": "SA", "pipeline": "SalesNight", "db": "sales"},
    "stock": {"app_prefix": "ST", "pipeline": "StockHourly", "db": "stock_v2"},
    "geo": {"app_prefix": "GE", "pipeline": "GeoWeekly", "db": "geo"},
    "trade": {"sales": ["invoices", "refunds"], "stock": ["moves"], "geo": []},
    "maps": {"geo": ["sites"]},
}


def documents(spark, tmp_path, content):
    path = tmp_path / "list.json"
    path.write_text(json.dumps(content, indent=4))
    return read_documents(spark, str(path))


def test_table_list(spark, tmp_path):
    docs = documents(spark, tmp_path, LIST)
    trade = [
        ("trade", "SA", "SalesNight", "sales", "invoices"), ("trade", "SA", "SalesNight", "sales", "refunds"),
        ("trade", "ST", "StockHourly", "stock_v2", "moves"),
    ]
    maps = [("maps", "GE", "GeoWeekly", "geo", "sites")]
    assert rows(expand_tables(docs, "trade")) == trade and rows(expand_tables(docs)) == maps + trade
    assert expand_tables(docs, "none").count() == 0
    assert rows(poll_defaults(docs)) == [("ask", "/lib/poll.jar", "state", "tables", "XY", "night")]


def test_a_domain_may_use_a_database_called_db(spark, tmp_path):
    docs = documents(spark, tmp_path, {
        "db": {"app_prefix": "A", "pipeline": "P", "db": "db"}, "own": {"db": ["t"]}})
    assert rows(expand_tables(docs)) == [("own", "A", "P", "db", "t")]


def test_table_list_with_unknown_or_conflicting_database(spark, tmp_path):
    docs = documents(spark, tmp_path, {**LIST, "trade": {"moon": ["craters"]}})
    with pytest.raises(PySparkException, match="no attributes for database moon"):
        expand_tables(docs, "trade").collect()
    again = spark.createDataFrame(
        [(json.dumps({"geo": {"app_prefix": "GE", "pipeline": "GeoDaily", "db": "earth"}}),)], "value string")
    same = spark.createDataFrame([(json.dumps({"sales": LIST["sales"]}),)], "value string")
    docs = documents(spark, tmp_path, LIST).unionByName(again).unionByName(same)
    with pytest.raises(PySparkException, match="conflicting attributes for database geo"):
        expand_tables(docs, "maps").collect()
    assert expand_tables(docs, "trade").count() == 3


def test_summary_by_hand(spark):
    at = lambda hour: dt.datetime(2022, 7, 5, hour)
    data = [
        ("d", "a", "SUCCESS", at(1)), ("d", "a", "FAILURE", at(3)), ("d", "a", "SUCCESS", at(2)),
        ("d", "b", "NO_CHANGE", at(1)), ("d", "b", "MAINTENANCE", at(1)), ("d", "c", "other", at(1)),
    ]
    events = spark.createDataFrame(data, "domain string, table string, status string, ts timestamp_ntz")
    summary = status_summary(events)
    assert rows(summary) == [
        ("d", "a", at(3), "FAILURE", at(2), None, at(3), None),
        ("d", "b", at(1), "NO_CHANGE", None, at(1), None, at(1)),
    ]
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_watch_ends_where_the_batch_check_does(spark, root, tmp_path):
    events = status_events(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    source = str(tmp_path / "events")
    events.repartitionByRange(4, "ts").write.parquet(source)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    seen = []
    watch_domain(
        arriving, f"{root}/a", "domain_1", "2024-01-30", lambda: "2024-01-30 14:00:00",
        str(tmp_path / "checkpoint"), every=None, on_verdict=seen.append,
    ).awaitTermination()
    batch = check_domain(
        status_summary(events), f"{root}/b", "domain_1", "2024-01-30", "2024-01-30 14:00:00")
    assert len(seen) == 4 and seen[-1] == batch
    assert listed(spark, f"{root}/a", "failed") == listed(spark, f"{root}/b", "failed")


def test_watch_goes_on_where_it_stopped(spark, root, tmp_path):
    at = lambda day, hour: dt.datetime(2022, 7, day, hour)
    fields = "domain string, table string, status string, ts timestamp_ntz"
    source, seen = str(tmp_path / "events"), []
    batches = [
        [("d", "a", "SUCCESS", at(5, 1)), ("d", "b", "SUCCESS", at(4, 1)), ("x", "c", "FAILURE", at(4, 1))],
        [("d", "b", "NO_CHANGE", at(5, 2))],
        [("d", "new", "FAILURE", at(5, 3))],
    ]
    for arrived in batches:
        spark.createDataFrame(arrived, fields).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(fields).parquet(source)
        watch_domain(
            events, root, "d", "2022-07-05", lambda: "2022-07-05 14:00:00",
            str(tmp_path / "checkpoint"), every=None, on_verdict=seen.append,
        ).awaitTermination()
    assert seen == ["WAIT", "READY", "WAIT"]
    assert listed(spark, root, "ready") == ["a", "b"] and listed(spark, root, "failed") == ["new"]


EVENT = "domain string, table string, status string, ts timestamp_ntz"


def arrived(spark, source, *events):
    spark.createDataFrame(list(events), EVENT).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(EVENT).parquet(source)


def moving(*moments):
    """A clock that goes on with every look and then stands still."""
    left = list(moments)
    return lambda: left.pop(0) if len(left) > 1 else left[0]


def test_deadline_passes_after_the_last_event(spark, root, tmp_path):
    """One event, then silence: WAIT before the cut-off, FAILED from it on."""
    at = dt.datetime(2022, 7, 5, 1)
    events = arrived(spark, str(tmp_path / "events"), ("d", "a", "SUCCESS", at), ("d", "b", "FAILURE", at))
    seen = []
    clock = moving("2022-07-05 14:00:00", "2022-07-05 15:58:59", "2022-07-05 15:59:00")
    query = watch_domain(events, root, "d", "2022-07-05", clock, str(tmp_path / "checkpoint"),
                         every="0 seconds", on_verdict=seen.append)
    while "FAILED" not in seen:
        assert not query.awaitTermination(0.2)
    query.stop()
    assert seen[:3] == ["WAIT", "WAIT", "FAILED"] and listed(spark, root, "failed") == ["b"]


def test_deadline_holds_after_a_restart(spark, root, tmp_path):
    at = dt.datetime(2022, 7, 5, 1)
    source, checkpoint = str(tmp_path / "events"), str(tmp_path / "checkpoint")
    events = arrived(spark, source, ("d", "a", "FAILURE", at), ("x", "c", "SUCCESS", at))
    seen = []
    query = watch_domain(events, root, "d", "2022-07-05", lambda: "2022-07-05 14:00:00", checkpoint,
                         every="0 seconds", on_verdict=seen.append)
    while len(seen) < 2:
        assert not query.awaitTermination(0.2)
    query.stop()
    assert set(seen) == {"WAIT"}
    # Nothing new but the time of day.
    again = spark.readStream.schema(EVENT).parquet(source)
    verdict = await_verdict(again, root, "d", "2022-07-05", lambda: "2022-07-05 16:30:00", checkpoint, "0 seconds")
    assert verdict == "FAILED" and listed(spark, root, "failed") == ["a"]


def test_watch_ends_when_ready(spark, root, tmp_path):
    at = dt.datetime(2022, 7, 5, 1)
    events = arrived(spark, str(tmp_path / "events"), ("d", "a", "SUCCESS", at))
    verdict = await_verdict(events, root, "d", "2022-07-05", lambda: "2022-07-05 14:00:00",
                            str(tmp_path / "checkpoint"), "0 seconds")
    assert verdict == "READY" and listed(spark, root, "ready") == ["a"]


def test_expected_tables_that_never_report(spark, root, tmp_path):
    at = dt.datetime(2022, 7, 5, 1)
    expected = spark.createDataFrame([("d", "a"), ("d", "silent"), ("x", "b"), ("d", "a")], "domain string, table string")
    events = arrived(spark, str(tmp_path / "events"), ("d", "a", "SUCCESS", at), ("d", "more", "SUCCESS", at))
    clock = moving("2022-07-05 14:00:00", "2022-07-05 16:00:00")
    verdict = await_verdict(events, root, "d", "2022-07-05", clock, str(tmp_path / "checkpoint"), "0 seconds", expected)
    assert verdict == "FAILED" and listed(spark, root, "failed") == ["silent"]
    nothing = spark.readStream.schema(EVENT).parquet(str(tmp_path / "events")).where("false")
    clock = moving("2022-07-05 14:00:00", "2022-07-05 16:00:00")
    verdict = await_verdict(nothing, root, "d", "2022-07-05", clock, str(tmp_path / "other"), "0 seconds", expected)
    assert verdict == "FAILED" and listed(spark, root, "failed") == ["a", "silent"]


def test_a_watch_that_fails_says_so(spark, root, tmp_path):
    events = arrived(spark, str(tmp_path / "events"), ("d", "a", "SUCCESS", dt.datetime(2022, 7, 5, 1)))

    def broken():
        raise OSError("no clock")

    with pytest.raises(PySparkException, match="no clock"):
        await_verdict(events, root, "d", "2022-07-05", broken, str(tmp_path / "checkpoint"), "0 seconds")

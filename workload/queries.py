"""Sample queries: every operator on the given tables, over whole tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import (
    classify_freshness, classify_log, duplicate_check, error_lines, metrics_export, null_check,
    previous_snapshot, previous_snapshot_dates, previous_snapshots, readiness, rows_print, status_summary,
    stored_counts,
    transform_counts, verdict,
)
from tidemark.plans import (
    IngestionError, check_domains, check_quality, export_errors, ingest_domain, kept_null_check, publish_status,
    replace_snapshot, replace_snapshots, report_batch, run_quality, write_errors,
)
from tidemark.functions import next_ingest_at, normalise_space, previous_day
from tidemark.sinks import shared_path, write_lines
from tidemark.sinks.files import Files
from tidemark.sources import (
    QualityRule, expand_tables, poll_defaults, previous_stored_dates, quality_rules, read_document_lines, read_history,
    read_ingestion_mapping, read_log, read_metric_mapping, read_rule_mapping, read_snapshot,
    read_snapshots, read_status, register_partitions, run_stored_query, status_records, sync_partitions,
)
from tidemark.streaming import arriving_log, await_verdict, deliver_log, watch_domain
from workload.tables import (
    DAY, FIRST_DAY, LAST_DAY, RUN_TS, balances, plain, status_events, table, transactions,
)

DATABASE = "lake"
RUN = dict(source_type=DATABASE, run_ts=RUN_TS)

def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rule(table_name, nulls=(), keys=(), override="None"):
    return QualityRule(table_name, tuple(nulls), tuple(keys), (override,))


# --- quality ---------------------------------------------------------------------------


def _balance_nulls(override="None", fields=("dirty",)):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = [_rule("balances", fields, override=override)]
        return plain(null_check(balances(spark, sf_dir), rules, table="balances", **RUN))

    return query


def null_check_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        _rule("transactions", ["flag"], override="ConditionalNullsNonVBO"),
        _rule("transactions", ["flag", "amount", "account_type"], override="ConditionalNullsNonLegacy"),
        _rule("transactions", ["amount"], override="ConditionalNulls"),
        _rule("transactions", ["flag", "amount"]),
    ]
    return plain(null_check(transactions(spark, sf_dir), rules, table="transactions", **RUN))


def null_check_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several overrides in one rule: the narrowest scope listed first in the table of scopes wins."""
    rules = [
        QualityRule("balances", ("dirty",), (), ("ConditionalNullsNonVBO", "ConditionalNulls")),
        QualityRule("balances", ("dirty",), (), ("ConditionalDupNonLegacy", "ConditionalNullsNonVBO")),
        QualityRule("balances", (), ("account_id",), ("ConditionalNulls", "ConditionalDupNonLegacy")),
    ]
    return plain(run_quality({"balances": balances(spark, sf_dir)}, rules, **RUN))


def null_check_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily use: one snapshot, several rules, one scan."""
    rules = [
        _rule("balances", ["dirty"]),
        _rule("balances", ["dirty"], override="ConditionalNulls"),
        _rule("balances", ["dirty"], override="ConditionalNullsNonLegacy"),
        _rule("balances", ["dirty"], override="ConditionalNullsNonVBO"),
    ]
    checked = null_check(balances(spark, sf_dir), rules, table="balances", as_of=DAY, **RUN)
    return plain(checked)


def null_check_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances that arrive in two files per day; the second run reads the later ones alone."""
    rules = [_rule("balances", ["dirty"]), _rule("balances", ["dirty", "amount"], override="ConditionalNulls")]
    root, kept = shared_path(spark, "arriving"), shared_path(spark, "kept")
    rows = balances(spark, sf_dir)
    clicks = F.coalesce(F.col("account_type"), F.lit("")) == "VBA"
    for part in (clicks, ~clicks):
        rows.where(part).repartition("as_of_date").write.mode("append").partitionBy("as_of_date").parquet(root)
        found = kept_null_check(spark, root, rows.schema, rules, kept, table="balances", **RUN)
    return plain(found)


def _balance_duplicates(keys, override="None"):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = [_rule("balances", keys=keys, override=override)]
        return plain(duplicate_check(balances(spark, sf_dir), rules, table="balances", **RUN))

    return query


def duplicate_check_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        _rule("transactions", keys=["supplier_id", "flag"]),
        _rule("transactions", keys=["supplier_id", "flag"], override="ConditionalDupNonLegacy"),
        _rule("transactions", keys=["part_id"]),
    ]
    return plain(duplicate_check(transactions(spark, sf_dir), rules, table="transactions", **RUN))


def duplicate_check_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose whole text occurs more than once, as one undated snapshot."""
    documents = table(spark, sf_dir, "documents").withColumn("as_of_date", F.lit(DAY).cast("date"))
    rules = [_rule("documents", keys=["text"])]
    return plain(duplicate_check(documents, rules, table="documents", **RUN))


def duplicate_check_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments padded with non-breaking spaces on some rows, alike once normalised."""
    padded = F.concat("c_mktsegment", F.when(F.col("c_nationkey") > 9, "\u00a0 \u00a0").otherwise(""))
    customers = normalise_space(_customers(spark, sf_dir).withColumn("segment", padded))
    rules = [_rule("customers", keys=["segment"])]
    return plain(duplicate_check(customers, rules, table="customers", **RUN))


QUALITY_RULES = [
    _rule("balances", ["dirty"], override="ConditionalNullsNonVBO"),
    _rule("balances", ["dirty", "account_type", "amount"], override="ConditionalNullsNonLegacy"),
    _rule("balances", ["amount"], override="ConditionalNulls"),
    _rule("balances", keys=["account_id"], override="ConditionalDupNonLegacy"),
    _rule("transactions", ["account_id", "flag"]),
    _rule("transactions", keys=["supplier_id"]),
]


def quality_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"balances": balances(spark, sf_dir), "transactions": transactions(spark, sf_dir)}
    return plain(run_quality(tables, QUALITY_RULES, **RUN))


def quality_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of all dates written, then one table found clean: what remains stored."""
    tables = {"balances": balances(spark, sf_dir), "customers": _customers(spark, sf_dir)}
    rules = [*QUALITY_RULES[:4], _rule("customers", keys=["c_nationkey"])]
    root, days = shared_path(spark, "errors"), _days(tables["balances"])
    write_errors(run_quality(tables, rules, **RUN), root, days, list(tables))
    clean = run_quality(tables, [_rule("customers", keys=["c_custkey"])], **RUN)
    write_errors(clean, root, [DAY], ["customers"])
    return plain(spark.read.schema(schemas.SQL_ERRORS).parquet(root))


def quality_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped rules run twice for a day; the second time all checks of one table are off."""
    tables = {"balances": balances(spark, sf_dir), "customers": _customers(spark, sf_dir)}
    root = shared_path(spark, "checked")
    for balance_check in ("dirty,amount", "None"):
        lines = spark.createDataFrame(
            [("balances", balance_check, "None", "stock", "None"),
             ("customers", "None", "c_mktsegment", "stock", "None")], schemas.RULE_MAPPING)
        mapping = read_rule_mapping(spark, _write_mapping(lines, "checks"), "stock")
        check_quality(mapping, tables.__getitem__, root, DATABASE, DAY, RUN_TS)
    return plain(spark.read.schema(schemas.SQL_ERRORS).parquet(f"{root}/{DATABASE}/metrics/sql_errors"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumn("as_of_date", F.lit(DAY).cast("date"))


# --- mapping files ----------------------------------------------------------------------


def _write_mapping(lines: DataFrame, name: str) -> str:
    path = shared_path(lines.sparkSession, name)
    lines.write.option("sep", "|").option("header", True).option("quote", "").csv(path)
    return path


def _ingestion_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.lower("c_name").alias("source_table"),
        F.upper("c_name").alias("target_table"),
        F.concat(F.lit("folder_"), F.col("c_nationkey")).alias("target_folder"),
        F.lit("upstream").alias("source_database"),
        F.lit(DATABASE).alias("target_database"),
        F.col("c_mktsegment").alias("domain_name"),
    )


def ingestion_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of every domain, and one table by its name in another case."""
    path = _write_mapping(_ingestion_lines(spark, sf_dir), "ingestion_mapping")
    one = read_ingestion_mapping(spark, path, "HOUSEHOLD", "customer#000000000")
    return read_ingestion_mapping(spark, path).unionByName(one)


def rule_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "part").select(
        F.concat(F.lit("table_"), F.col("p_partkey")).alias("input_fname"),
        F.when(F.col("p_size") % 2 == 0, F.concat_ws(",", "p_brand", "p_name"))
        .otherwise("None").alias("null_check"),
        F.when(F.col("p_size") % 3 == 0, "None").otherwise("p_name,p_brand").alias("dup_check"),
        F.col("p_type").alias("domain"),
        F.when(F.col("p_size") % 5 == 0, "ConditionalNulls,ConditionalDupNonLegacy")
        .otherwise("None").alias("dq_overrides"),
    )
    path = _write_mapping(lines, "rule_mapping")
    return read_rule_mapping(spark, path).select(
        "target_table",
        F.array_join("null_check", "+").alias("null_check"),
        F.size("null_check").cast("long").alias("n_fields"),
        "dup_check",
        "domain",
        F.array_join("dq_overrides", "+").alias("dq_overrides"),
    )


def metric_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("src_"), F.col("o_orderkey")).alias("source_table"),
        F.concat(F.lit("Tgt_"), F.col("o_custkey")).alias("target_table"),
        F.lit("upstream").alias("source_database"),
        F.lit(DATABASE).alias("target_database"),
        F.col("o_orderstatus").alias("target_folder"),
        F.col("o_orderpriority").alias("batch_type"),
    )
    path = _write_mapping(lines, "metric_mapping")
    one = read_metric_mapping(spark, path, "5-LOW", "src_0")
    wrong_case = read_metric_mapping(spark, path, "5-LOW", "SRC_0")
    return _all([read_metric_mapping(spark, path), one, wrong_case])


# --- ingestion --------------------------------------------------------------------------


def _days(df: DataFrame) -> list:
    """The dates that occur: partition keys, not rows."""
    return [row.as_of_date for row in df.select("as_of_date").distinct().collect()]


def snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates stored, one replaced by its VBA rows, the day before by nothing."""
    df = balances(spark, sf_dir)
    root = shared_path(spark, "balances")
    replace_snapshots(df, root, _days(df))
    day = dt.date.fromisoformat(DAY)
    on_day = df.where(F.col("as_of_date") == F.lit(day))
    replace_snapshot(on_day.where(F.col("account_type") == "VBA"), root, day)
    replace_snapshot(df.where(F.lit(False)), root, day - dt.timedelta(days=1))
    stored = read_history(spark, root, df.schema)
    return plain(stored.groupBy("as_of_date").agg(
        F.count(F.lit(1)).alias("dest_count"),
        F.sum("event_id").alias("sum_ids"),
        F.count("dirty").alias("n_dirty"),
    ))


def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored snapshot by its date in one scan, and one date alone."""
    df = balances(spark, sf_dir)
    root, days = shared_path(spark, "scan"), _days(df)
    replace_snapshots(df, root, days)
    one = read_snapshot(spark, root, DAY, df.schema)
    return plain(read_snapshots(spark, root, days, df.schema).unionByName(one))


def catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snapshot written, made visible in a catalog table and counted through it."""
    df = balances(spark, sf_dir)
    root, days = shared_path(spark, "catalog"), _days(df)
    name = "balances_" + root.rsplit("-", 1)[-1]
    columns = ", ".join(f"{column} {kind}" for column, kind in df.dtypes)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (as_of_date) "
        f"LOCATION '{root}'"
    )
    counts = shared_path(spark, "catalog_counts")
    try:
        replace_snapshots(df, root, days)
        register_partitions(spark, name, days)
        stored_counts(spark.table(name), DATABASE, "balances").write.parquet(counts)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return plain(spark.read.parquet(counts))


def catalog_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog that missed every write and remembers a date that is gone, set right."""
    df = balances(spark, sf_dir)
    root, days = shared_path(spark, "synced"), _days(df)
    name = "balances_" + root.rsplit("-", 1)[-1]
    columns = ", ".join(f"{column} {kind}" for column, kind in df.dtypes)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (as_of_date) "
        f"LOCATION '{root}'"
    )
    counts = shared_path(spark, "synced_counts")
    try:
        register_partitions(spark, name, ["1999-12-31"])
        Files(spark, root).delete("as_of_date=1999-12-31")
        replace_snapshots(df, root, days)
        added, dropped = sync_partitions(spark, name, root)
        known = spark.sql(f"SHOW PARTITIONS {name}").count()
        stored_counts(spark.table(name), DATABASE, "balances").withColumns({
            "added": F.lit(added), "dropped": F.lit(dropped), "known": F.lit(known)}).write.parquet(counts)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return plain(spark.read.parquet(counts))


def _write_query(spark: SparkSession, directory: str, target: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{directory}/{target}.hql")


def _stored_queries(spark: SparkSession, sf_dir: str) -> str:
    """Line items are of the 1990s, so their cut-off lies as many years before the run date."""
    balances(spark, sf_dir).createOrReplaceTempView("upstream_balances")
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("upstream_lineitem")
    directory = shared_path(spark, "queries")
    _write_query(spark, directory, "positions", """
        SELECT account_id, account_type, count(*) AS n_rows, count(dirty) AS n_dirty
        FROM upstream_balances WHERE as_of_date <= CAST(${as_of_date} AS DATE)
        GROUP BY account_id, account_type;
    """)
    _write_query(spark, directory, "shipments", """
        SELECT l_orderkey AS account_id, l_linenumber AS line, l_returnflag AS flag
        FROM upstream_lineitem
        WHERE l_shipdate < CAST(:next_ingest_date AS TIMESTAMP_NTZ) - INTERVAL 28 YEARS
          AND l_shipdate >= CAST(:prev_ingest_date AS TIMESTAMP_NTZ) - INTERVAL 29 YEARS
    """)
    _write_query(spark, directory, "unusable", "SELECT '${as_of_date}' AS day")
    return directory


def stored_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stored_query(spark, _stored_queries(spark, sf_dir), "Positions", DAY)


#: Target databases and tables of an ingestion; one name occurs in two databases.
TARGETS = (("lake", "positions"), ("vault", "positions"), ("lake", "shipments"))


def _ingested(spark: SparkSession, sf_dir: str, targets) -> DataFrame:
    directory, root = _stored_queries(spark, sf_dir), shared_path(spark, "lake")
    lines = spark.createDataFrame(
        [(f"{target}_feed", target, f"{database}_{target}", "upstream", database, "stock")
         for database, target in targets], schemas.INGESTION_MAPPING)
    mapping = read_ingestion_mapping(spark, _write_mapping(lines, "mapping"), "stock")
    for day in (LAST_DAY, DAY):
        try:
            ingest_domain(
                spark, mapping, lambda target: run_stored_query(spark, directory, target, day),
                root, "stock", day, RUN_TS, files=4)
        except IngestionError as error:
            assert set(error.failed) == {"lake.unusable"}
    return plain(_all([
        spark.read.schema(schemas.TRANSFORM_COUNTS).parquet(f"{root}/{database}/metrics/transform_counts")
        for database in sorted({database for database, _ in targets})
    ]))


def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of two databases ingested for two days: the metric rows as stored."""
    return _ingested(spark, sf_dir, TARGETS)


def ingest_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table fails: the metric rows of the others are stored all the same."""
    return _ingested(spark, sf_dir, (TARGETS[0], ("lake", "unusable"), TARGETS[2]))


def _histories(spark: SparkSession, sf_dir: str) -> dict[tuple[str, str], DataFrame]:
    """Rows of every target, by database and table. One name occurs in two databases."""
    df = balances(spark, sf_dir)
    return {
        ("lake", "balances"): df,
        ("vault", "balances"): df.where(F.col("account_type") == "VBA"),
        ("lake", "transactions"): transactions(spark, sf_dir),
    }


def _by_date(df: DataFrame, target: tuple[str, str]) -> DataFrame:
    """Rows per date, counted in one scan and then kept: one row per date."""
    counted = stored_counts(df, *target)
    return df.sparkSession.createDataFrame(counted.collect(), counted.schema)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Produced against stored: one table misses its last date, and was not asked for its first."""
    produced, stored = [], []
    for target, df in _histories(spark, sf_dir).items():
        found = _by_date(df, target)
        root = shared_path(spark, "-".join(target))
        kept = df
        if target == ("lake", "balances"):
            kept = df.where(F.col("as_of_date") < F.lit(LAST_DAY).cast("date"))
            found = found.where(F.col("as_of_date") > F.lit(FIRST_DAY).cast("date"))
        days = {row.as_of_date for row in found.collect()} | {dt.date.fromisoformat(FIRST_DAY)}
        replace_snapshots(kept, root, sorted(days))
        produced.append(found.withColumnRenamed("dest_count", "src_count"))
        stored.append(_by_date(read_history(spark, root, df.schema), target))
    mapping = spark.createDataFrame(
        [(f"{name}_feed", name, f"{database}_{name}", "upstream", database, "stock")
         for database, name in _histories(spark, sf_dir)], schemas.INGESTION_MAPPING)
    return transform_counts(_all(produced), _all(stored), mapping, RUN_TS)


def transform_counts_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_counts(spark, sf_dir))


# --- metric report ----------------------------------------------------------------------


def previous_snapshot_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot before a day, and before the first day of all."""
    df = balances(spark, sf_dir)
    days = [previous_snapshot(df, day) for day in (DAY, "2024-01-01")]
    return plain(days[0].unionByName(days[1]))


def previous_snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = [
        df.select(F.lit(database).alias("dest_db"), F.lit(name).alias("dest_tbl"), "as_of_date")
        for (database, name), df in _histories(spark, sf_dir).items()
    ]
    return plain(previous_snapshots(_all(named)))


def previous_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily and monthly tables in one call, on a day of the one and years after the other."""
    found = previous_snapshot_dates(_histories(spark, sf_dir), DAY)
    return plain(spark.createDataFrame(
        [(*target, day) for target, day in found.items()],
        "dest_db string, dest_tbl string, yest_ingest_dt date"))


def reconcile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date stored as produced, but for one where a row is swapped for another."""
    df, root = balances(spark, sf_dir), shared_path(spark, "reconciled")
    target = (F.lit("lake").alias("dest_db"), F.lit("balances").alias("dest_tbl"))
    produced = df.groupBy("as_of_date").agg(
        F.count(F.lit(1)).alias("src_count"), rows_print(df).alias("src_print")).select(*target, "*")
    days = [row.as_of_date for row in produced.select("as_of_date").collect()]
    replace_snapshots(df, root, days)
    day = df.where(F.col("as_of_date") == F.lit(DAY).cast("date"))
    first = day.agg(F.min("event_id")).first()[0]
    swapped = F.when(F.col("event_id") == first, F.col("account_id") + 1).otherwise(F.col("account_id"))
    replace_snapshot(day.withColumn("account_id", swapped), root, DAY)
    stored = stored_counts(read_history(spark, root, df.schema), "lake", "balances", prints=True)
    mapping = spark.createDataFrame(
        [("feed", "balances", "lake_balances", "upstream", "lake", "stock")], schemas.INGESTION_MAPPING)
    counts = transform_counts(produced, stored, mapping, RUN_TS)
    return plain(counts.select("as_of_date", "src_count", "dest_count", "error_msg"))


def previous_dates_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the names of stored partitions; one table's newest one holds no row."""
    root, emptied = shared_path(spark, "listed"), "2024-01-14"
    paths = {}
    for target, df in _histories(spark, sf_dir).items():
        paths[target] = f"{root}/{'/'.join(target)}"
        days = [row[0] for row in df.select("as_of_date").distinct().collect()]
        replace_snapshots(df, paths[target], [*days, emptied])
    replace_snapshot(spark.range(0), paths[min(paths)], emptied)
    found = previous_stored_dates(spark, paths, DAY)
    return plain(spark.createDataFrame(
        [(*target, day) for target, day in found.items()],
        "dest_db string, dest_tbl string, yest_ingest_dt date"))


def run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next ingest time and previous day of every snapshot date."""
    days = transactions(spark, sf_dir).select("as_of_date").distinct()
    return plain(days.select(
        "as_of_date",
        next_ingest_at(F.col("as_of_date")).alias("next_ingest_date"),
        previous_day(F.col("as_of_date")).alias("prev_ingest_date"),
    ))


def _metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(
        [(f"{name}_feed", name, "upstream", database, f"{database}_{name}", "evening")
         for database, name in _histories(spark, sf_dir)], schemas.METRIC_MAPPING)


def metrics_export_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _counts(spark, sf_dir)
    return plain(metrics_export(counts, previous_snapshots(counts), _metric_rows(spark, sf_dir)))


def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered file of one day, line by line: both tables that have a snapshot then."""
    path = report_batch(
        _counts(spark, sf_dir), _histories(spark, sf_dir), _metric_rows(spark, sf_dir),
        shared_path(spark, "report"), "evening", DAY)
    return spark.read.text(path)


# --- freshness --------------------------------------------------------------------------


def _table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents naming each customer as a table of its nation's database."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    lists = customers.select(F.to_json(
        F.create_map("r_name", F.create_map("n_name", F.array("c_name")))
    ).alias("value"))
    attributes = nations.select(F.to_json(F.create_map("n_name", F.struct(
        F.concat(F.lit("P"), F.col("n_nationkey")).alias("app_prefix"),
        F.concat_ws("_", "r_name", F.lit("Ingestion")).alias("pipeline"),
        F.col("n_name").alias("db"),
    ))).alias("value"))
    defaults = table(spark, sf_dir, "region").select(F.to_json(F.create_map(
        F.lit("defaults"), F.struct(
            F.lit("poll").alias("action"), F.lit("status").alias("messageType"),
            F.col("r_name").alias("pipeline"),
        ),
    )).alias("value"))
    path = shared_path(spark, "table_list")
    lists.unionByName(attributes).unionByName(defaults).write.text(path)
    return read_document_lines(spark, path)


def table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of all domains at once, and of one."""
    documents = _table_list(spark, sf_dir)
    return expand_tables(documents).unionByName(expand_tables(documents, "ASIA"))


def table_list_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poll_defaults(_table_list(spark, sf_dir)).select("action", "messageType", "pipeline")


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_summary(status_events(table(spark, sf_dir, "events")))


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_status(spark, sf_dir).withColumnRenamed("table", "table_name"))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        classify_freshness(_status(spark, sf_dir), LAST_DAY)
        .select("domain", F.col("table").alias("table_name"), "is_fresh")
    )


def readiness_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts around the cut-off in winter and in summer time, and with nothing stale."""
    moments = [
        "2024-01-30 16:58:59", "2024-01-30 16:59:00", "2024-07-30 15:58:59", "2024-07-30 15:59:00",
    ]
    judged = classify_freshness(_status(spark, sf_dir), LAST_DAY)
    # The counts are taken once; each moment only needs its own verdict.
    counted = readiness(judged, moments[0]).withColumn(
        "now_utc", F.explode(F.array(*[F.lit(moment) for moment in moments]))
    )
    every = counted.withColumn("verdict", verdict(F.col("n_stale"), F.col("now_utc")))
    fresh = readiness(judged.where("is_fresh"), moments[0])
    return every.unionByName(fresh.withColumn("now_utc", F.lit("fresh only")))


def _as_records(df: DataFrame) -> DataFrame:
    """Summary rows in the form a status service sends: text, ``NA`` for no time."""
    def text(name):
        shown = F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.coalesce(shown, F.lit("NA")).alias(name)

    return df.select(
        text("lastUpdated"), "latestStatus", F.lit("APP").alias("appPrefix"),
        F.lit("Ingestion").alias("pipeline"), text("lastSuccess"), text("lastFailure"),
        text("lastNoChange"), text("lastMaintenance"),
        F.date_format("lastUpdated", "yyyy-MM-dd'T'HH.mm.ss.SSS").alias("as_of_date"),
        F.lit("NA").alias("other"), "domain", "table",
    )


def _stored_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "status")
    _as_records(_status(spark, sf_dir)).write.json(path)
    return read_status(spark, path)


def poll_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poll responses, one JSON object of table to record each, judged for a day."""
    records = _as_records(_status(spark, sf_dir))
    fields = [F.col(name) for name in schemas.STATUS_RECORD.names]
    responses = records.select(F.to_json(F.create_map("table", F.struct(*fields))).alias("value"))
    judged = classify_freshness(status_records(responses, "all"), LAST_DAY)
    return judged.select("domain", F.col("table").alias("table_name"), "latestStatus", "is_fresh")


def status_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_path(spark, "table_status")
    stored = _stored_status(spark, sf_dir)
    publish_status(stored, root, LAST_DAY)
    publish_status(stored, root, LAST_DAY, "domain_0")
    return plain(spark.read.parquet(root)).select(
        "as_of_date", "dest_tbl", F.col("table").alias("table_name"), "latestStatus",
        "lastSuccess", "lastNoChange",
    )


def ready_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of every domain: checked too late, and in time when nothing is stale."""
    root = shared_path(spark, "lists")
    stored = _stored_status(spark, sf_dir)
    fresh = classify_freshness(stored, LAST_DAY).where("is_fresh").drop("is_fresh")
    check_domains(stored, root, LAST_DAY, "2024-01-30 20:00:00")
    check_domains(fresh, root, LAST_DAY, "2024-01-30 14:00:00")
    lists = [
        spark.read.schema(schemas.STATUS).json(f"{root}/{name}").select(
            F.lit(name).alias("list"), "domain", F.col("table").alias("table_name"), "latestStatus"
        )
        for name in ("ready", "failed")
    ]
    return lists[0].unionByName(lists[1])


def readiness_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events of all tables arriving in several files; the list after the last one."""
    source, root = shared_path(spark, "status_events"), shared_path(spark, "watched")
    events = status_events(table(spark, sf_dir, "events")).withColumn("domain", F.lit("all"))
    events.repartitionByRange(4, "ts").write.parquet(source)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    watch_domain(
        arriving, root, "all", LAST_DAY, lambda: "2024-01-30 14:00:00",
        shared_path(spark, "watch_checkpoint"), every=None,
    ).awaitTermination()
    listed = spark.read.schema(schemas.STATUS).json(f"{root}/failed")
    return listed.select("domain", F.col("table").alias("table_name"), "latestStatus")


def readiness_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing arrives after the events of all tables, and the cut-off comes: who failed."""
    source, root = shared_path(spark, "status_events"), shared_path(spark, "deadline")
    events = status_events(table(spark, sf_dir, "events")).withColumn("domain", F.lit("all"))
    events.repartitionByRange(2, "ts").write.parquet(source)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    looks = iter(["2024-01-30 14:00:00"] * 3)
    outcome = await_verdict(
        arriving, root, "all", LAST_DAY, lambda: next(looks, "2024-01-30 16:59:00"),
        shared_path(spark, "deadline_checkpoint"), "0 seconds")
    listed = spark.read.schema(schemas.STATUS).json(f"{root}/failed")
    return listed.select(F.lit(outcome).alias("verdict"), F.col("table").alias("table_name"), "latestStatus")


# --- text for the indexer ---------------------------------------------------------------


def error_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error lines of every date and both tables."""
    tables = {"balances": balances(spark, sf_dir), "transactions": transactions(spark, sf_dir)}
    return error_lines(run_quality(tables, QUALITY_RULES, **RUN), "2003").select("value")


def error_export_tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tabs inside a key turn into bars."""
    keyed = _customers(spark, sf_dir).withColumn("nation", F.col("c_nationkey").cast("string")).withColumn(
        "label", F.concat_ws("\t", "c_mktsegment", "nation"))
    found = run_quality({"customers": keyed}, [_rule("customers", keys=["label"])], **RUN)
    return error_lines(found, "2003").select("value")


def error_export_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines delivered for all dates of a domain with a code of its own."""
    lines = spark.createDataFrame(
        [("balances", "amount,dirty", "None", "stock", "ConditionalNullsNonVBO"),
         ("balances", "None", "account_type,account_id", "stock", "ConditionalDupNonLegacy")],
        schemas.RULE_MAPPING)
    rules = quality_rules(read_rule_mapping(spark, _write_mapping(lines, "rules"), "stock"))
    stored, root = shared_path(spark, "errors"), shared_path(spark, "error_lines")
    df = balances(spark, sf_dir)
    days = _days(df)
    write_errors(run_quality({"balances": df}, rules, **RUN), stored, days, ["balances"])
    back = spark.read.schema(schemas.SQL_ERRORS).parquet(stored)
    export_errors(back, root, days, "stock", ["balances"], code="2417")
    return spark.read.text(root).select("value")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of a log for each event."""
    kind = F.col("event_type")
    level = (
        F.when(kind == "error", "Error").when(kind == "click", "WARN").when(kind == "view", "NOTE")
        .when(kind == "purchase", "ERROR").otherwise("info")
    )
    tail = F.when(F.col("event_id") % 7 == 0, " Exception").otherwise("")
    return table(spark, sf_dir, "events").select(
        F.concat(level, F.lit(": event "), F.col("event_id"), F.lit(" "), F.col("props"), tail)
        .alias("value")
    )


def log_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines read from files, classified, delivered and read again."""
    lines = _log(spark, sf_dir)
    path, root = shared_path(spark, "log"), shared_path(spark, "log_lines")
    lines.write.text(path)
    log = read_log(spark, path)
    ingested = classify_log(log, DAY, "account", "data_ingestion")
    checked = classify_log(log, DAY, "account", "dq_check", upper_domain=True)
    write_lines(ingested, root, DAY, "job", "data_ingestion")
    write_lines(checked, root, DAY, "job", "dq_check")
    return spark.read.text(root).select("value")


def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log arriving in pieces, some before and some after a restart; what was delivered."""
    folder, root = shared_path(spark, "log_pieces"), shared_path(spark, "log_batches")
    checkpoint = shared_path(spark, "log_checkpoint")
    early, late = _log(spark, sf_dir).randomSplit([0.5, 0.5], seed=5)
    for piece in (early, late):
        piece.repartition(3).write.mode("append").text(folder)
        deliver_log(arriving_log(spark, folder, files_at_once=1), root, DAY, "account", "data_ingestion",
                    checkpoint).awaitTermination()
    return spark.read.text(root).select("value")


QUERIES = {
    "null_check": _balance_nulls(),
    "null_check_scope_vba": _balance_nulls("ConditionalNulls"),
    "null_check_scope_vba_ta": _balance_nulls("ConditionalNullsNonLegacy"),
    "null_check_scope_not_vbo": _balance_nulls("ConditionalNullsNonVBO"),
    "null_check_numeric": _balance_nulls(fields=("amount",)),
    "null_check_multi": _balance_nulls(fields=("dirty", "account_type")),
    "null_check_transactions": null_check_transactions,
    "null_check_overrides": null_check_overrides,
    "null_check_day": null_check_day,
    "null_check_kept": null_check_kept,
    "duplicate_check": _balance_duplicates(("account_id",)),
    "duplicate_check_scope": _balance_duplicates(("account_id",), "ConditionalDupNonLegacy"),
    "duplicate_check_multi_key": _balance_duplicates(("account_id", "account_type")),
    "duplicate_check_transactions": duplicate_check_transactions,
    "duplicate_check_texts": duplicate_check_texts,
    "duplicate_check_normalised": duplicate_check_normalised,
    "quality_run": quality_run,
    "quality_write": quality_write,
    "quality_check": quality_check,
    "ingestion_mapping": ingestion_mapping,
    "rule_mapping": rule_mapping,
    "metric_mapping": metric_mapping,
    "snapshot_replace": snapshot_replace,
    "snapshot_scan": snapshot_scan,
    "catalog_partitions": catalog_partitions,
    "catalog_sync": catalog_sync,
    "stored_query": stored_query,
    "ingest_domain": ingest,
    "ingest_failing": ingest_failing,
    "transform_counts": transform_counts_history,
    "previous_snapshot": previous_snapshot_of_days,
    "previous_snapshot_history": previous_snapshot_history,
    "previous_dates": previous_dates,
    "previous_dates_listed": previous_dates_listed,
    "reconcile_rows": reconcile_rows,
    "run_dates": run_dates,
    "metrics_export": metrics_export_history,
    "metrics_report": metrics_report,
    "expand_tables": table_list,
    "poll_defaults": table_list_defaults,
    "status_summary": status,
    "freshness": freshness,
    "readiness": readiness_at,
    "poll_response": poll_response,
    "status_publish": status_publish,
    "ready_list": ready_list,
    "readiness_watch": readiness_watch,
    "readiness_deadline": readiness_deadline,
    "error_export": error_export,
    "error_export_tabs": error_export_tabs,
    "error_export_file": error_export_file,
    "log_classify": log_classify,
    "log_stream": log_stream,
}

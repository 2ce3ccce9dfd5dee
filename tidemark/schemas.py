"""Schemas of the files and tables the jobs exchange."""

from pyspark.sql import types as T


def _strings(*names):
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column order of the three pipe-delimited mapping files.
INGESTION_MAPPING = _strings(
    "source_table", "target_table", "target_folder",
    "source_database", "target_database", "domain_name",
)
RULE_MAPPING = _strings("input_fname", "null_check", "dup_check", "domain", "dq_overrides")
METRIC_MAPPING = _strings(
    "source_table", "target_table", "source_database",
    "target_database", "target_folder", "batch_type",
)

# Fields of one status record as the status service returns it.
STATUS_RECORD = _strings(
    "lastUpdated", "latestStatus", "appPrefix", "pipeline", "lastSuccess",
    "lastFailure", "lastNoChange", "lastMaintenance", "as_of_date", "other",
)
STATUS = T.StructType(
    STATUS_RECORD.fields
    + [T.StructField("domain", T.StringType()), T.StructField("table", T.StringType())]
)

# Shape of the upstream table list.
DATABASE_ATTRIBUTES = _strings("app_prefix", "pipeline", "db")
POLL_DEFAULTS = _strings("action", "jarPath", "messageType", "subject", "app_prefix", "pipeline")

# Columns of the two metric tables; the last two of each are partition keys.
TRANSFORM_COUNTS = T.StructType([
    T.StructField("src_db", T.StringType()),
    T.StructField("src_tbl", T.StringType()),
    T.StructField("src_count", T.LongType()),
    T.StructField("src_add", T.LongType()),
    T.StructField("src_edit", T.LongType()),
    T.StructField("src_delete", T.LongType()),
    T.StructField("dest_db", T.StringType()),
    T.StructField("dest_count", T.LongType()),
    T.StructField("dest_add", T.LongType()),
    T.StructField("dest_edit", T.LongType()),
    T.StructField("dest_delete", T.LongType()),
    T.StructField("dest_edit_add", T.LongType()),
    T.StructField("dest_delete_add", T.LongType()),
    T.StructField("dest_add_change", T.LongType()),
    T.StructField("lst_updt_ts", T.TimestampType()),
    T.StructField("error_msg", T.StringType()),
    T.StructField("as_of_date", T.DateType()),
    T.StructField("dest_tbl", T.StringType()),
])
SQL_ERRORS = T.StructType([
    T.StructField("source_type", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("null_count", T.LongType()),
    T.StructField("error_detail", T.StringType()),
    T.StructField("lst_updt_ts", T.TimestampType()),
    T.StructField("as_of_date", T.DateType()),
    T.StructField("tbl_nm", T.StringType()),
])

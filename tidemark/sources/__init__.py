from tidemark.sources.logs import read_log
from tidemark.sources.mappings import (
    QualityRule, mapped_tables, quality_rules, read_ingestion_mapping, read_metric_mapping,
    read_rule_mapping,
)
from tidemark.sources.partition_dates import previous_stored_dates, stored_days, sync_partitions
from tidemark.sources.snapshots import (
    read_history, read_or_nothing, read_snapshot, read_snapshots, register_partitions,
)
from tidemark.sources.status import read_status, status_records
from tidemark.sources.stored_query import run_stored_query
from tidemark.sources.table_list import (
    expand_tables, poll_defaults, read_document_lines, read_documents,
)

__all__ = [
    "QualityRule", "expand_tables", "mapped_tables", "poll_defaults", "quality_rules",
    "previous_stored_dates", "read_document_lines",
    "read_documents", "read_history", "read_ingestion_mapping", "read_log",
    "read_metric_mapping", "read_rule_mapping", "read_or_nothing", "read_snapshot",
    "read_snapshots", "read_status", "register_partitions", "run_stored_query", "status_records",
    "stored_days", "sync_partitions",
]

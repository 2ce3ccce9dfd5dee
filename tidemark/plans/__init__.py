from tidemark.plans.ingestion import (
    IngestionError, ingest_domain, replace_snapshot, replace_snapshots, write_transform_counts,
)
from tidemark.plans.kept_counts import kept_null_check
from tidemark.plans.metrics import report_batch
from tidemark.plans.quality import check_quality, export_errors, run_quality, write_errors
from tidemark.plans.readiness import check_domain, check_domains, publish_status, write_lists

__all__ = [
    "IngestionError", "check_domain", "check_domains", "check_quality", "export_errors",
    "ingest_domain", "kept_null_check", "publish_status", "replace_snapshot", "replace_snapshots", "report_batch",
    "run_quality", "write_errors", "write_lists", "write_transform_counts",
]

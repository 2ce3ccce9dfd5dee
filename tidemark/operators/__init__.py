from tidemark.operators.duplicate_check import duplicate_check
from tidemark.operators.freshness import (
    FAILED, READY, WAIT, classify_freshness, readiness, status_summary, verdict,
)
from tidemark.operators.metrics_export import metrics_export
from tidemark.operators.null_check import null_check
from tidemark.operators.previous_snapshot import (
    previous_snapshot, previous_snapshot_dates, previous_snapshots,
)
from tidemark.operators.reconcile import rows_print, stored_counts, transform_counts
from tidemark.operators.table_check import table_check
from tidemark.operators.text_lines import classify_log, error_code, error_lines

__all__ = [
    "FAILED", "READY", "WAIT", "classify_freshness", "classify_log", "duplicate_check",
    "error_code", "error_lines", "metrics_export", "null_check", "previous_snapshot",
    "previous_snapshot_dates", "previous_snapshots", "readiness", "rows_print", "status_summary",
    "stored_counts", "table_check", "transform_counts", "verdict",
]

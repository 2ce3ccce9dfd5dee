"""Dated snapshots on Spark: ingest, reconcile, check quality and freshness, report."""

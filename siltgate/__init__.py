"""Daily ingestion of tabular feeds on Spark: quality gates, quarantine and dated snapshots."""

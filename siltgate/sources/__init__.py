"""Readers and writers: typed CSV feeds, CSV quarantine, dated parquet snapshots, scratch folders."""

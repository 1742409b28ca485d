"""Readers: parquet tables, strict CSV scans, the TESTDATA adapter, named tables."""

"""Writers: overwrite parquet/tables, manifests, checked loads."""

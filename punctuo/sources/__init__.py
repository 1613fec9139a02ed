"""Sources (CSV/zip readers), the Parquet sink and the test-table bindings."""

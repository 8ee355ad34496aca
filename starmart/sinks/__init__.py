"""Writers: CSV tables and extracts, typed warehouse tables, sorted Parquet, DDL."""

"""Sources: JSON-lines / CSV readers, the parquet-table adapter, generated
JSON lines for the tables, and artifact tables."""

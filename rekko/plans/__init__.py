"""Plans: the registered queries, their DuckDB statements and the batch job."""

"""The registered queries: domain views over the given tables, Spark jobs, DuckDB equivalents."""

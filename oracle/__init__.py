"""ANSI-SQL counterparts of the registered queries, for DuckDB."""

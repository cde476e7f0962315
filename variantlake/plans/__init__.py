"""Job runners and the registered queries (with their DuckDB oracles)."""

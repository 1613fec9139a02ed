"""Named queries over the bindings and their DuckDB oracle SQL."""

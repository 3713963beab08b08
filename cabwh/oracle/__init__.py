"""DuckDB oracle: the same derivations and queries in SQL, for the correctness check."""

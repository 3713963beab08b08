"""Sources: the given tables, derived fleet tables, file drops, incremental extraction."""

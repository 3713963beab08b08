"""Table operators: pivot, point-in-time lookup, write algebra, SCD2, split windows."""

"""Plans: facts, dimensions, reports, the daily pipeline and the query registry."""

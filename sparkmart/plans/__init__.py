"""Reports and the query registry (key -> Spark callable + oracle SQL)."""

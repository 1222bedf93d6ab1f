"""Monthly business-registry extracts as trusted, query-ready Spark tables."""

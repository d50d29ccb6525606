"""Payment records on Spark: parse, store by key, query, report."""

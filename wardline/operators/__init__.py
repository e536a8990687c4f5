"""DataFrame operators: dedup, checks, feeds, change feed, incremental refresh."""

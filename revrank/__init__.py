"""revrank: revenue-aware top-k recommendation as plain Spark jobs."""

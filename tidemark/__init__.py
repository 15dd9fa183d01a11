"""Change-data folding, event enrichment and metric rules as Spark jobs."""

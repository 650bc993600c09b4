"""placeloom: place enrichment, scoring and corpus preparation as Spark jobs."""

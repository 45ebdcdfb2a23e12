"""creditloom: lending features, scoring, rank metrics, portfolio and drift as Spark jobs."""

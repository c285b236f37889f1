"""Column functions: no Spark jobs, no session."""

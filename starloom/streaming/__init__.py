"""Bronze, silver and gold loads in Structured Streaming and in batches."""

"""Extensions beyond the batch catalog: incremental ingest with Structured Streaming."""

"""Structured Streaming jobs: bronze, silver, incremental gold."""

"""Structured Streaming jobs: incremental landing and the month-wise upsert of the fact."""

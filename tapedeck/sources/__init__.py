"""Readers and writers of the lake: bronze JSON, silver and gold Parquet, catalogue, state."""

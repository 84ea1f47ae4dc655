"""Table builders and jobs."""

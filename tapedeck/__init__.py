"""Medallion analytics for media-listening history, written as Spark DataFrame jobs."""

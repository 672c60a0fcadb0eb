"""Retail-bank analytics warehouse expressed as Spark jobs."""

"""Catalogue analytics written as Spark DataFrame jobs."""

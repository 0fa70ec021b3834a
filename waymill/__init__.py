"""Waymill: fleet and mobility analytics, and corpus preparation, as Spark DataFrame jobs."""

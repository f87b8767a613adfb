"""Tick, bar and sensor analytics written as Spark jobs."""

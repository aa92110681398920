"""Ratings lakehouse and event-window analytics as Spark jobs."""

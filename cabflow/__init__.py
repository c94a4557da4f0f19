"""Ride dispatch and dynamic-pricing analytics as Spark jobs."""

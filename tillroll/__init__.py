"""Layered retail-order analytics as plain Spark jobs."""

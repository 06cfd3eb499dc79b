"""Clickloom: point-in-time click features, ranking and profiling on Spark."""

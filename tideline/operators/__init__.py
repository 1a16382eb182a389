"""Operators on telemetry tables: cleaning, profiling and exploration."""

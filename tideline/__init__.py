"""Analytics for time-ordered telemetry on Spark: sources, cleaning, features, datasets and profiling."""

__version__ = "0.1.0"

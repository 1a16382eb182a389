"""Readers and writers of telemetry tables."""

from .files import read_raw, read_table, synthetic_cycles, write_table

__all__ = ["read_raw", "read_table", "synthetic_cycles", "write_table"]

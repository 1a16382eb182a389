"""Streaming forms of the windowed features and of resampling."""

from .rolling import stream_resample, stream_rolling

__all__ = ["stream_resample", "stream_rolling"]

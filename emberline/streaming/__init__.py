"""Structured Streaming entry points."""

from .scoring import scored_stream, start_scoring

__all__ = ["scored_stream", "start_scoring"]

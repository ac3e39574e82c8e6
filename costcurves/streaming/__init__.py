"""The actual curve as a stream."""

from .curve import stream_costs

__all__ = ["stream_costs"]

"""Structured Streaming entry points (micro-batch refresh of silver tables)."""

from refinery.streaming.incremental import bronze_stream, refresh_stream, release, unique_changes

__all__ = ["bronze_stream", "refresh_stream", "release", "unique_changes"]

"""Incremental ingest: the line validator on a Structured Streaming file source."""

from tillroll.streaming.ingest import start_line_split, stream_lines

__all__ = ["start_line_split", "stream_lines"]

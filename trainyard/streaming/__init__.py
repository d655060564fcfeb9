"""Streaming entry points."""

from trainyard.streaming.ingest import start_snapshot_stream

__all__ = ["start_snapshot_stream"]

"""Structured Streaming exports."""

from docquarry.streaming.incremental import IncrementalExport

__all__ = ["IncrementalExport"]

"""Structured Streaming re-expression of the bronze ingest."""

from terrace.streaming.ingest import ingest_landing, quarantine_of, read_landed, report_of

__all__ = ["ingest_landing", "quarantine_of", "read_landed", "report_of"]

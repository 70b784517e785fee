"""Streaming ingestion (file arrival -> keyed merge into the fact)."""

from contrail.streaming.ingest import ingest_available

__all__ = ["ingest_available"]

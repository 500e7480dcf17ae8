"""Structured Streaming operators: running value counts and the ledger."""

from tessera.streaming.counts import stream_counts
from tessera.streaming.ledger import stream_ledger

__all__ = ["stream_counts", "stream_ledger"]

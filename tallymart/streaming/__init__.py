"""Batches that arrive over time."""

from tallymart.streaming.ingest import ingest_available, ingest_batches
from tallymart.streaming.ledger import Ledger

__all__ = ["Ledger", "ingest_available", "ingest_batches"]

"""Streaming entry points.

The source contract is batch-oriented (late data is absorbed by recomputing
from raw), so the only stream is the arrival of new batches: a Structured
Streaming file source over batch manifests drives the same idempotent raw
ingest (see ``ingest``).
"""

from tallyframe.streaming.ingest import ingest_new_batches, manifest_stream

__all__ = ["ingest_new_batches", "manifest_stream"]

"""tallyframe: Spark-native operators for auditable transaction tables.

Every operator takes and returns DataFrames and is built from Spark SQL
expressions, joins, aggregations and windows.  Sub-packages:

- ``functions``  column builders: validation predicates, hashes, casts
- ``operators``  table operators: validation, latest-wins, SCD2, point-in-time
                 binding, marts, reconciliation checks
- ``sources``    readers and writers: JSONL batches, manifests, file metadata,
                 event logs, the generator, and the testdata proxy model
- ``plans``      multi-step jobs: versioned tables and upsert, the prepare
                 recompute, publication, run journal, benchmark variants
- ``streaming``  incremental raw ingest on Structured Streaming
"""

from tallyframe.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]

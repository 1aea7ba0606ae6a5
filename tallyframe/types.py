"""Source contract: entity field lists, accepted domains and target schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the source contract (must stay equal for equal results).
ENTITIES = ("customers", "accounts", "transactions")
ENTITY_FIELDS = {
    "customers": ("change_version", "customer_id", "effective_at", "region", "segment"),
    "accounts": ("account_id", "currency", "customer_id", "opened_at", "record_version", "status"),
    "transactions": ("account_id", "amount", "channel", "currency", "direction", "event_at",
                     "record_version", "source_updated_at", "status", "transaction_id"),
}
OPTIONAL_FIELDS = {"transactions": ("memo",)}
SEGMENTS = ("RETAIL", "PREMIUM", "BUSINESS")
CURRENCIES = ("RUB", "USD", "EUR")
ACCOUNT_STATUSES = ("ACTIVE", "CLOSED")
TRANSACTION_STATUSES = ("POSTED", "PENDING", "CANCELLED")
DIRECTIONS = ("IN", "OUT")
CHANNELS = ("CARD", "TRANSFER", "ATM")
# Field checks of each entity after the required fields; their order is the order of reason codes.
CONTRACT = {
    "customers": {"change_version": "version", "effective_at": "utc timestamp", "segment": SEGMENTS},
    "accounts": {"record_version": "version", "currency": CURRENCIES, "status": ACCOUNT_STATUSES, "opened_at": "date"},
    "transactions": {"record_version": "version", "currency": CURRENCIES, "event_at": "utc timestamp", "source_updated_at": "utc timestamp",
                     "amount": "money", "status": TRANSACTION_STATUSES, "direction": DIRECTIONS, "channel": CHANNELS},
}
MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(38, 2)
DEFAULT_MAX_REJECT_RATIO = 0.10
SHARD_RECORDS = 100_000


def payload_fields(entity: str, schema_version: int = 2) -> tuple[str, ...]:
    """Alphabetical field list used to parse an entity's payload."""
    extra = OPTIONAL_FIELDS.get(entity, ()) if schema_version >= 2 else ()
    return tuple(sorted(ENTITY_FIELDS[entity] + extra))


def payload_schema(entity: str, schema_version: int = 2) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in payload_fields(entity, schema_version)])


RAW_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("source_record_id", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("schema_version", T.IntegerType()),
])

QUARANTINE_COLUMNS = ("entity", "payload", "batch_id", "source_record_id", "reason", "ingested_at")

TRANSACTION_COLUMNS = ("transaction_id", "account_id", "customer_id", "customer_version_id", "event_at",
                       "source_updated_at", "received_at", "record_version", "amount", "currency", "status",
                       "direction", "channel", "record_hash")

ACCOUNT_COLUMNS = ("account_id", "customer_id", "currency", "opened_at", "status", "record_version",
                   "received_at")

MANIFEST_SCHEMA = ("processing_date STRING, label STRING, schema_version INT, "
                   "files ARRAY<STRUCT<entity STRING, name STRING, records BIGINT, sha256 STRING>>, "
                   "batch_id STRING")

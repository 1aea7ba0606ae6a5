"""Rule-based validation with reason codes, the valid/rejected split and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe import types as TT
from tallyframe.functions.hashing import record_hash
from tallyframe.functions.predicates import entity_rules

Rule = tuple[Column, str]


class DataQualityError(ValueError):
    """Raised when a batch breaks a quality threshold; carries the metrics."""

    def __init__(self, message: str, metrics: dict):
        super().__init__(message)
        self.metrics = metrics


def parse_payload(df: DataFrame, entity: str, payload: str = "payload", into: str = "p",
                  schema_version: int = 2) -> DataFrame:
    """Parse JSON text by the entity's closed, alphabetical field list.

    Undeclared fields are dropped; malformed JSON yields a struct of NULLs,
    which then fails every ``required:`` rule.

    The struct comes out of a one-element ``inline`` generator: a filter on
    rule results (``reason = ''``) cannot be pushed beneath a generator, so
    the optimizer cannot re-inline the parser into every rule predicate and
    each payload is parsed once per row.
    """
    parsed = F.from_json(F.col(payload), TT.payload_schema(entity, schema_version))
    return df.select("*", F.inline(F.array(F.struct(parsed.alias(into)))))


def reason_column(rules: Sequence[Rule]) -> Column:
    """``;``-joined labels of failed rules in rule order; '' when all pass.

    A rule whose condition is NULL counts as failed.
    """
    return F.concat_ws(";", *[F.when(F.coalesce(cond, F.lit(False)), F.lit(None)).otherwise(F.lit(label))
                              for cond, label in rules])


def apply_rules(df: DataFrame, rules: Sequence[Rule], reason: str = "reason") -> DataFrame:
    return df.withColumn(reason, reason_column(rules))


def check_entity(raw: DataFrame, entity: str, schema_version: int = 2) -> DataFrame:
    """Parse + reason codes + record hash for one entity of the raw table."""
    parsed = parse_payload(raw.filter(F.col("entity") == entity), entity, schema_version=schema_version)
    return apply_rules(parsed, entity_rules(entity)).withColumn("record_hash", record_hash("p"))


def split(checked: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) halves of a checked DataFrame; persist ``checked`` first when both are used."""
    return checked.filter(F.col(reason) == ""), checked.filter(F.col(reason) != "")


def as_rejects(df: DataFrame, reason: Column | str = "reason") -> DataFrame:
    reason = F.col(reason) if isinstance(reason, str) else reason
    return df.select("entity", "payload", "batch_id", "source_record_id", reason.alias("reason"), "ingested_at")


def quarantine(*rejects: DataFrame) -> DataFrame:
    """Union of reject sets by column name (each raw row appears at most once)."""
    out = rejects[0].select(*TT.QUARANTINE_COLUMNS)
    for df in rejects[1:]:
        out = out.unionByName(df.select(*TT.QUARANTINE_COLUMNS))
    return out


def quarantine_by_reason(q: DataFrame) -> DataFrame:
    return q.groupBy("entity", "reason").agg(F.count(F.lit(1)).alias("rejected_count"))


def reject_ratio(checked: DataFrame, by: str = "batch_id", maximum: float = TT.DEFAULT_MAX_REJECT_RATIO,
                 reason: str = "reason") -> DataFrame:
    """Per-batch read / rejected / accepted counts and the breach flag
    ``rejected / max(read, 1) > maximum`` (exact decimal comparison).

    One pass with partial aggregation: each map task sends one row per batch.
    """
    out = checked.groupBy(by).agg(F.count(F.lit(1)).alias("read_count"),
                                  F.count_if(F.col(reason) != "").alias("rejected_count"))
    return out.withColumn("accepted_count", F.col("read_count") - F.col("rejected_count")).withColumn(
        "breach", F.col("rejected_count") > F.greatest(F.col("read_count"), F.lit(1)) * F.lit(Decimal(str(maximum))))


def enforce(metrics: dict, maximum: float = TT.DEFAULT_MAX_REJECT_RATIO) -> dict:
    """Raise DataQualityError when ``rejected / max(read, 1) > maximum`` (strict)."""
    read, rejected = int(metrics["read_count"]), int(metrics["rejected_count"])
    if rejected / max(read, 1) > maximum:
        raise DataQualityError(f"Critical DQ: rejected {rejected}/{read}, threshold {maximum}", metrics)
    return metrics

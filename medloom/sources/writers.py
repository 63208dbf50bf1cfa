"""Sinks: partitioned JSON and text exports, additive upserts, decision logs and caches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_entities(entities: DataFrame, path: str, status: str = "VALIDATED") -> None:
    """JSON lines of the rows with the given status, in folders by entity type."""
    entities.where(F.col("status") == status).write.mode("overwrite").partitionBy("entity_type").json(path)


def export_texts(docs: DataFrame, path: str) -> None:
    """One line of JSON text per document."""
    docs.select(F.to_json(F.struct("doc_id", "text")).alias("value")).write.mode("overwrite").text(path)


def status_totals(entities: DataFrame) -> DataFrame:
    """Rows by entity type and status."""
    return entities.groupBy("entity_type", "status").agg(F.count("*").alias("n"))


def append_usage(facts: DataFrame, path: str) -> None:
    """Append counters; ``read_usage`` adds them up, so a repeated write of new facts never rewrites old ones."""
    facts.write.mode("append").parquet(path)


def read_usage(facts: DataFrame, keys: list[str], counters: list[str]) -> DataFrame:
    return facts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])


def log_decisions(decisions: DataFrame, path: str) -> None:
    """Append decisions as JSON lines."""
    decisions.write.mode("append").json(path)


def fresh(cache: DataFrame, now, ttl_seconds: int) -> DataFrame:
    """Cached rows that haven't expired; of several with one key, the latest."""
    alive = cache.where(F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("cached_at").cast("timestamp")) <= ttl_seconds)
    return alive.groupBy("key").agg(F.max_by("value", F.struct("cached_at", "value")).alias("value"))

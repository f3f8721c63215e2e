"""The ingestion plan: raw payloads to events and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tollgate.config import IngestConfig
from tollgate.operators.ingest import accepted_events, mask_payloads, rejects


def ingest(
    payloads: DataFrame, cfg: IngestConfig | None = None, now_ms: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) of a payload table."""
    masked = mask_payloads(payloads, cfg, now_ms)
    return accepted_events(masked), rejects(masked, cfg)

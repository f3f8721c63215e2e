"""The batch enrichment plan: dedup, velocity, geo, device, assemble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tollgate.config import ProcessorConfig
from tollgate.operators.dedup import dedup
from tollgate.operators.device import device_profile
from tollgate.operators.enrich import assemble, judged, overflow_letters, split_overflow
from tollgate.operators.geo import geolocate
from tollgate.operators.velocity import velocity
from tollgate.schemas import ENRICHED
from tollgate.session import write_durable, write_split


def _profiled(transactions: DataFrame, blocks: DataFrame, cfg: ProcessorConfig) -> DataFrame:
    """Unique transactions with all features.

    Each feature is a column of one lineage, so no join puts them together. The deduplicated rows
    are written once to the shared folder: every operator also needs a narrow aggregate of them,
    which then reads two or three columns of files instead of repeating the plan so far.
    """
    unique = write_durable(dedup(transactions, cfg.dedup_ttl_ms), "unique")
    counted = velocity(unique, cfg.skew, cfg.velocity_mode)
    placed = geolocate(counted, blocks, cfg.skew, cfg.geo_confidence, base=unique)
    return device_profile(placed, cfg.skew, cfg.device_idle_ms, base=unique)


def enrich(
    transactions: DataFrame,
    blocks: DataFrame,
    cfg: ProcessorConfig | None = None,
    enrichment_time: Column | None = None,
) -> DataFrame:
    """Decoded transactions with source coordinates to enriched records.

    A row with a feature beyond its contract type is left out; ``enrich_all`` gives its letter.
    """
    cfg = cfg or ProcessorConfig()
    good, _ = split_overflow(_profiled(transactions, blocks, cfg), enrichment_time)
    return assemble(good, cfg, enrichment_time)


def enrich_all(
    transactions: DataFrame,
    blocks: DataFrame,
    cfg: ProcessorConfig | None = None,
    enrichment_time: Column | None = None,
    counted: Observation | None = None,
    **stamps: Column,
) -> tuple[DataFrame, DataFrame]:
    """Decoded transactions with source coordinates to enriched records and dead letters.

    A row with a feature beyond its contract type becomes a letter. ``stamps`` go to the letters.
    The features are worked out once: rows are written with their outcome, a folder for each, and
    both results read their own folder. ``counted`` receives ``records`` and ``overflows`` from
    that pass.
    """
    cfg = cfg or ProcessorConfig()
    rows = judged(_profiled(transactions, blocks, cfg), cfg, enrichment_time)
    if counted is not None:
        rows = rows.observe(
            counted,
            F.count_if(F.col("_overflow").isNull()).alias("records"),
            F.count_if(F.col("_overflow").isNotNull()).alias("overflows"),
        )
    outcome = F.when(F.col("_overflow").isNull(), "record").otherwise("letter")
    written = write_split(rows.withColumn("_outcome", outcome), "outcomes", "_outcome", 2)
    records = written.where("_outcome = 'record'").select(*ENRICHED.fieldNames())
    return records, overflow_letters(written.where("_outcome = 'letter'"), **stamps)

"""The whole second stage as a batch plan: log records to enriched records and one dead-letter table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tollgate.config import ProcessorConfig
from tollgate.operators.dlq import late_events, schema_failures, stable_id, union_failures
from tollgate.operators.frame import decode
from tollgate.operators.lateness import with_watermark_and_lateness
from tollgate.plans.enrichment import enrich_all
from tollgate.schemas import DECODED, ENRICHMENT_ERROR, LATE_ERROR, SCHEMA_ERROR, SOURCE
from tollgate.session import write_durable, write_split


@dataclass(frozen=True)
class Processed:
    """Results of ``process``. ``accepted`` are the rows neither unreadable nor late, repeats included."""

    records: DataFrame
    letters: DataFrame
    accepted: DataFrame
    decoded: DataFrame
    counters: DataFrame


def process(
    log: DataFrame,
    blocks: DataFrame,
    cfg: ProcessorConfig | None = None,
    enrichment_time: Column | None = None,
    body: str = "avro",
    **stamps: Column,
) -> Processed:
    """Decode, route late rows, drop repeats, enrich; every failure becomes one letter.

    A log record ends as exactly one of: a letter (unreadable, late, or with a feature beyond its
    type), a record, or a repeat that dedup dropped. Letter ids follow from the source coordinates;
    ``stamps`` go to the letters. An empty log gives empty tables and counters of zero.

    Each stage is worked out once and written with its outcome. The bodies are parsed in the first
    pass; lateness needs the highest time of every block of offsets first, which it reads from one
    column of that pass. Letters read the folder or the pushed-down filter of their outcome. The
    counters are observed in the final stage of each write, where a task counts once however often
    it was tried, so they cost no scan.
    """
    cfg = cfg or ProcessorConfig()
    spark = log.sparkSession
    read, routed, enriched = (Observation(name) for name in ("read", "routed", "enriched"))
    decoded = write_durable(
        decode(log, body, cfg.expected_schema_id).observe(
            read,
            F.count(F.lit(1)).alias("rows"),
            F.count("decode_error").alias("unreadable"),
        ),
        "decoded",
    )
    sound = decoded.where(F.col("decode_error").isNull()).drop("decode_error")
    flagged = with_watermark_and_lateness(sound, cfg).withColumns(
        {
            "value": F.when(F.col("is_late"), F.col("value")),  # the others are not needed as bytes
            "_outcome": F.when(F.col("is_late"), "late").otherwise("accepted"),
        }
    )
    flagged = flagged.observe(
        routed, F.count_if("is_late").alias("late"), F.count_if(~F.col("is_late")).alias("accepted")
    )
    tagged = write_split(flagged, "routed", "_outcome", 2)
    accepted = tagged.where("_outcome = 'accepted'").select(*SOURCE.fieldNames(), *DECODED.fieldNames())
    records, overflowed = enrich_all(
        accepted,
        blocks,
        cfg,
        enrichment_time,
        enriched,
        dlq_id=stable_id(F.lit("enrichment")),
        **stamps,
    )
    letters = union_failures(
        schema_failures(decoded, dlq_id=stable_id(F.lit("schema")), **stamps),
        late_events(
            tagged.where("_outcome = 'late'"),
            cfg.lateness_ms,
            dlq_id=stable_id(F.lit("late")),
            **stamps,
        ),
        overflowed,
    )
    seen = {**read.get, **routed.get, **enriched.get}
    totals = {
        "read": seen["rows"],
        SCHEMA_ERROR: seen["unreadable"],
        LATE_ERROR: seen["late"],
        ENRICHMENT_ERROR: seen["overflows"],
        "repeats_dropped": seen["accepted"] - seen["records"] - seen["overflows"],
        "records": seen["records"],
    }
    counters = spark.createDataFrame(list(totals.items()), "counter string, total bigint")
    return Processed(records, letters, accepted, decoded, counters)

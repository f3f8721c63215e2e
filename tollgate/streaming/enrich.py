"""Second query: dedup, velocity, device, geo and assembly per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tollgate.config import DAY_MS, MINUTE_MS, ProcessorConfig
from tollgate.operators.dlq import stable_id
from tollgate.operators.enrich import assemble, split_overflow
from tollgate.operators.geo import geolocate
from tollgate.schemas import DECODED, SOURCE
from tollgate.session import ship_package
from tollgate.streaming.commits import Commits
from tollgate.streaming.dedup import ACCEPTED, batch_dedup, near_times, next_times
from tollgate.streaming.device import SEGMENTS, batch_device, next_segments
from tollgate.streaming.processors import DedupProcessor
from tollgate.streaming.velocity import batch_velocity, joined_pieces, live_pieces, next_piece, read_pieces

VALID = T.StructType(
    [*SOURCE.fields, *DECODED.fields, T.StructField("routed_watermark", T.LongType(), True)]
)
# How far files of one routed batch may trail the next one's; the clock of the query waits for them.
_CLOCK_SLACK = "10 minutes"


def read_valid(spark: SparkSession, root: str, cfg: ProcessorConfig) -> DataFrame:
    """Stream of routed rows."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in VALID.fields])
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", cfg.max_files_per_trigger)
        .parquet(f"{root}/valid")
        .select(*VALID.fieldNames())
    )


def stream_dedup(rows: DataFrame, cfg: ProcessorConfig | None = None) -> DataFrame:
    """Drop rows less than the ttl from an accepted row of their id. Adds ``event_ts``, the clock.

    This is keyed Python state, for streams that go on to a sink of their own: calls to the state store
    for every id bound its speed. ``start_enrich`` and ``start_dedup`` keep the same rows by a table.

    The clock of the query is the watermark by which the route query accepted a row, not the row's
    own time: it never outruns acceptance, so a slow partition or a row from the future loses nothing.
    Rows from before the first watermark stand just behind the start of the clock, which is 0: a row
    at 0 itself would count as late.
    """
    cfg = cfg or ProcessorConfig()
    start = F.lit(1).cast("bigint")
    clock = F.timestamp_millis(F.greatest(F.col("routed_watermark"), start))
    clocked = rows.withColumn("event_ts", clock).withWatermark("event_ts", _CLOCK_SLACK)
    return clocked.groupBy("transaction_id").transformWithState(
        DedupProcessor(cfg.dedup_ttl_ms, cfg.lateness_ms),
        T.StructType([T.StructField(f.name, f.dataType, True) for f in clocked.schema.fields]),
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="event_ts",
    )


def write_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    blocks: DataFrame,
    cfg: ProcessorConfig,
    enrichment_time: Column | None = None,
    reached: Callable[[str], None] | None = None,
) -> None:
    """Finish one micro-batch of valid rows, repeats included.

    Its records, dead letters, accepted times, velocity and device state are committed together, once.
    """
    held = []
    commits = Commits(batch.sparkSession, path, reached)

    def outputs() -> dict[str, DataFrame]:
        if batch_id > 0 and not commits.done(batch_id - 1):
            raise FileNotFoundError(f"no commit of batch {batch_id - 1} under {path}")
        pieces = partial(read_pieces, batch.sparkSession, f"{path}/velocity")
        devices = partial(read_pieces, batch.sparkSession, f"{path}/device", schema=SEGMENTS)
        accepted = partial(read_pieces, batch.sparkSession, f"{path}/accepted", schema=ACCEPTED)
        live, joined = live_pieces(batch_id), joined_pieces(batch_id)
        clock, oldest, latest = batch.agg(
            F.max("routed_watermark"), F.min("event_time"), F.max("event_time")
        ).first()
        near = near_times(accepted(live), oldest, latest, cfg.dedup_ttl_ms)
        kept = batch_dedup(batch, near, cfg.dedup_ttl_ms).persist()
        held.append(kept)
        times = next_times(kept, accepted(joined), clock, cfg.dedup_ttl_ms, cfg.lateness_ms)
        state = pieces(live)
        if oldest is not None:
            state = state.where(F.col("minute") >= (oldest - DAY_MS) // MINUTE_MS)
        counted = batch_velocity(kept, state, cfg.skew)
        piece = next_piece(kept, pieces(joined), clock, cfg.lateness_ms)
        placed = geolocate(counted, blocks, cfg.skew, cfg.geo_confidence, base=kept)
        # records and letters are two outputs of these rows, which are worked out once
        profiled = batch_device(placed, devices(live), cfg.skew, cfg.device_idle_ms, base=kept).persist()
        held.append(profiled)
        stay = [number for number in live if number not in joined]
        replaced = devices(joined) if joined else None
        history = next_segments(kept, replaced, devices(stay), clock, cfg.lateness_ms, cfg.device_idle_ms)
        good, letters = split_overflow(
            profiled, enrichment_time, dlq_id=stable_id(F.lit("enrichment"))
        )
        records = assemble(good, cfg, enrichment_time)
        return {"enriched": records, "dlq": letters, "accepted": times, "velocity": piece, "device": history}

    try:
        commits.commit(batch_id, outputs)
        for replaced in joined_pieces(batch_id):
            commits.remove("accepted", replaced)
            commits.remove("velocity", replaced)
            commits.remove("device", replaced)
    finally:
        for df in held:
            df.unpersist()


def start_enrich(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    blocks: DataFrame,
    cfg: ProcessorConfig | None = None,
    enrichment_time: Column | None = None,
    once: bool = False,
    reached: Callable[[str], None] | None = None,
) -> StreamingQuery:
    """Start enriching a stream of valid rows into ``path``/enriched, dead letters into ``path``/dlq."""
    cfg = cfg or ProcessorConfig()
    ship_package(rows.sparkSession)
    writer = (
        rows.writeStream.queryName("enrich")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(
            lambda batch, batch_id: write_batch(
                batch, batch_id, path, blocks, cfg, enrichment_time, reached
            )
        )
    )
    writer = (
        writer.trigger(availableNow=True)
        if once
        else writer.trigger(processingTime=f"{cfg.checkpoint_interval_ms} milliseconds")
    )
    return writer.start()

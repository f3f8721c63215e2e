"""First query: decode, watermark, and split into valid rows and dead letters.

A watermark that drops late rows silently cannot feed a dead-letter table, so this query tracks
the watermark itself: the highest event time per source partition so far, its minimum over the
partitions, less the out-of-order allowance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tollgate.config import ProcessorConfig
from tollgate.operators.dlq import late_events, schema_failures, stable_id, union_failures
from tollgate.operators.frame import decode
from tollgate.streaming.commits import Commits

_MARKS = "source_topic string, source_partition int, high bigint"


def _high_marks(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """Highest event time per source partition after a batch: one small file per batch."""
    if batch_id < 0:
        return spark.createDataFrame([], _MARKS)
    if not Commits(spark, root).done(batch_id):
        raise FileNotFoundError(f"no watermark of batch {batch_id} under {root}/marks")
    return spark.read.schema(_MARKS).parquet(f"{root}/marks/batch_id={batch_id}")


def route_batch(
    log: DataFrame,
    batch_id: int,
    root: str,
    cfg: ProcessorConfig,
    body: str = "json",
    reached: Callable[[str], None] | None = None,
) -> None:
    """Route one micro-batch. Its outputs are committed together; a replay changes nothing.

    The watermark of a batch comes from the files of the batch before, so a replay of an
    unfinished batch routes exactly as the first attempt did.
    """
    spark = log.sparkSession
    commits = Commits(spark, root, reached)
    if commits.done(batch_id):
        return
    before = _high_marks(spark, root, batch_id - 1)
    watermark = before.agg((F.min("high") - cfg.watermark_ms).alias("watermark")).first()[0]
    decoded = decode(log, body, cfg.expected_schema_id).persist()
    try:
        commits.commit(batch_id, lambda: _outputs(decoded, before, watermark, cfg))
    finally:
        decoded.unpersist()


def _outputs(
    decoded: DataFrame, before: DataFrame, watermark: int | None, cfg: ProcessorConfig
) -> dict[str, DataFrame]:
    mark = F.lit(watermark).cast("bigint")
    late = F.coalesce(F.col("event_time") < mark - cfg.lateness_ms, F.lit(False))
    good = (
        decoded.where(F.col("decode_error").isNull())
        .drop("decode_error")
        .withColumns({"watermark": mark, "is_late": late})
    )
    valid = good.where(~F.col("is_late")).drop("value", "is_late")
    valid = valid.withColumnRenamed("watermark", "routed_watermark")
    dead = union_failures(
        schema_failures(decoded, dlq_id=stable_id(F.lit("schema"))),
        late_events(good, cfg.lateness_ms, dlq_id=stable_id(F.lit("late"))),
    )
    keys = ["source_topic", "source_partition"]
    # a partition that appears later starts at the watermark, which so never goes back
    high = F.greatest(F.max("event_time"), mark + cfg.watermark_ms)
    here = good.groupBy(*keys).agg(high.alias("high"))
    marks = before.unionByName(here).groupBy(*keys).agg(F.max("high").alias("high"))
    return {"valid": valid, "dlq": dead, "marks": marks.coalesce(1)}


def start_route(
    log: DataFrame,
    root: str,
    checkpoint: str,
    cfg: ProcessorConfig | None = None,
    body: str = "json",
    once: bool = False,
    reached: Callable[[str], None] | None = None,
) -> StreamingQuery:
    """Start routing a log stream into ``root``/valid, /dlq and /marks, with a commit for each batch."""
    cfg = cfg or ProcessorConfig()
    writer = (
        log.writeStream.queryName("route")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: route_batch(batch, batch_id, root, cfg, body, reached))
    )
    writer = (
        writer.trigger(availableNow=True)
        if once
        else writer.trigger(processingTime=f"{cfg.checkpoint_interval_ms} milliseconds")
    )
    return writer.start()

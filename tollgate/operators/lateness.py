"""Watermark and lateness in arrival order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.config import ProcessorConfig


def with_watermark_and_lateness(
    df: DataFrame, cfg: ProcessorConfig | None = None, block_rows: int = 65_536
) -> DataFrame:
    """Add ``watermark`` (before the row, null for the first) and ``is_late`` per source partition.

    The watermark is the highest earlier event time minus the out-of-order allowance; a row is
    late when it lies more than the allowed lateness behind it. A partition is cut into offset
    blocks: offsets are unique, so a block never holds more than ``block_rows`` rows.
    """
    cfg = cfg or ProcessorConfig()
    source = [name for name in ("source_topic", "source_partition") if name in df.columns]
    keys = [*source, "_block"]
    cut = df.withColumn("_block", F.expr(f"source_offset div {block_rows}L"))
    earlier_blocks = (
        Window.partitionBy(*source)
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    high = (
        cut.groupBy(*keys)
        .agg(F.max("event_time").alias("_high"))
        .select(*keys, F.max("_high").over(earlier_blocks).alias("_high_before"))
    )
    earlier_rows = (
        Window.partitionBy(*keys).orderBy("source_offset").rowsBetween(Window.unboundedPreceding, -1)
    )
    watermark = F.greatest("_high_before", "_high_here") - cfg.watermark_ms
    return (
        cut.withColumn("_high_here", F.max("event_time").over(earlier_rows))
        .join(high, keys)
        .withColumn("watermark", watermark)
        .withColumn(
            "is_late",
            F.coalesce(F.col("event_time") < F.col("watermark") - cfg.lateness_ms, F.lit(False)),
        )
        .select(*df.columns, "watermark", "is_late")
    )

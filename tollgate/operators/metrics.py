"""Counters, histograms, quantiles, rates, alerts and sizes as queries over the tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.config import DAY_MS, HOUR_MS, MINUTE_MS

# Histogram bounds in ms (the last bucket is open), sizes in bytes.
ENRICHMENT_BOUNDS = (1, 5, 10, 20, 50, 100, 250, 500)
PUBLISH_BOUNDS = (1, 2, 5, 10, 20, 50, 100, 500)
BUCKET_BYTES = 28
DEVICE_BYTES = 64
DEDUP_BYTES = 40
QUANTILES = (0.5, 0.95, 0.99)


def counter(df: DataFrame, labels: Sequence[str], name: str = "total") -> DataFrame:
    """Rows per label combination."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias(name))


def repeats_dropped(inputs: DataFrame, unique: DataFrame) -> DataFrame:
    """How many rows deduplication dropped, as one row."""
    tagged = inputs.select(F.lit(1).alias("n")).unionByName(unique.select(F.lit(-1).alias("n")))
    return tagged.agg(F.sum("n").alias("dedup_skipped_total"))


def _bucket_columns(value: Column, bounds: Sequence[int]) -> list[Column]:
    counts = [
        F.sum(F.when(value <= bound, 1).otherwise(0)).alias(f"_le{i}")
        for i, bound in enumerate(bounds)
    ]
    return [*counts, F.count(value).alias(f"_le{len(bounds)}")]


def histogram(
    df: DataFrame, value: str, bounds: Sequence[int], labels: Sequence[str] = ()
) -> DataFrame:
    """Cumulative histogram: labels, ``le`` (infinity last) and ``cumulative``."""
    wide = df.groupBy(*labels).agg(*_bucket_columns(F.col(value), bounds))
    rows = F.array(
        *[
            F.struct(
                F.lit(float(bound)).alias("le"),
                F.coalesce(F.col(f"_le{i}"), F.lit(0)).cast("bigint").alias("cumulative"),
            )
            for i, bound in enumerate([*bounds, float("inf")])
        ]
    )
    return wide.select(*labels, F.explode(rows).alias("_row")).select(*labels, "_row.*")


def histogram_quantiles(
    buckets: DataFrame, labels: Sequence[str] = (), quantiles: Sequence[float] = QUANTILES
) -> DataFrame:
    """Quantiles by linear interpolation inside the bucket that holds the rank.

    A rank in the open bucket gives the highest finite bound.
    """
    everything = Window.partitionBy(*labels) if labels else Window.partitionBy(F.lit(0))
    ordered = everything.orderBy("le")
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    spread = (
        buckets.withColumns(
            {
                "_total": F.max("cumulative").over(everything),
                "_below": F.coalesce(F.lag("cumulative").over(ordered), F.lit(0)),
                "_lower": F.coalesce(F.lag("le").over(ordered), F.lit(0.0)),
            }
        )
        .withColumn("quantile", F.explode(ranks))
        .withColumn("_rank", F.col("quantile") * F.col("_total"))
    )
    inside = (
        (F.col("_total") > 0)
        & (F.col("cumulative") >= F.col("_rank"))
        & ((F.col("_below") < F.col("_rank")) | (F.col("_lower") == 0.0) & (F.col("_below") == 0))
    )
    step = (F.col("_rank") - F.col("_below")) / F.nullif(
        F.col("cumulative") - F.col("_below"), F.lit(0)
    )
    value = F.when(F.col("le") == float("inf"), F.col("_lower")).otherwise(
        F.col("_lower") + (F.col("le") - F.col("_lower")) * F.coalesce(step, F.lit(0.0))
    )
    return spread.where(inside).groupBy(*labels, "quantile").agg(
        F.min_by(value, "le").alias("value")
    )


def exact_quantiles(
    df: DataFrame, value: str, quantiles: Sequence[float] = QUANTILES, coarse: int = 1024
) -> DataFrame:
    """Interpolated quantiles of an integer column, as (quantile, value).

    Rows are counted per distinct value, values are ranked within ranges of ``coarse`` values, and
    only the ranges' totals are ranked together, so no task sees more than the ranges' number.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("bigint").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_range", F.floor(F.col("_value") / coarse))
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counts.groupBy("_range").agg(F.sum("_n").alias("_in_range")).select(
        "_range", F.coalesce(F.sum("_in_range").over(before), F.lit(0)).alias("_base")
    )
    upto = Window.partitionBy("_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    total = counts.agg(F.sum("_n").alias("total")).scalar()
    ranked = (
        counts.withColumn("_upto", F.sum("_n").over(upto))
        .join(bases, "_range")
        .withColumns(
            {"_end": F.col("_base") + F.col("_upto"), "_start": F.col("_base") + F.col("_upto") - F.col("_n")}
        )
    )

    def at(index: Column) -> Column:
        held = (F.col("_start") <= index) & (index < F.col("_end"))
        return F.max(F.when(held, F.col("_value")))

    picks = []
    for i, q in enumerate(quantiles):
        position = F.lit(float(q)) * (total - 1)
        picks += [
            at(F.floor(position)).alias(f"_low{i}"),
            at(F.ceil(position)).alias(f"_high{i}"),
            F.max(position - F.floor(position)).alias(f"_part{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(float(q)).alias("quantile"),
                (
                    F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * F.col(f"_part{i}")
                ).alias("value"),
            )
            for i, q in enumerate(quantiles)
        ]
    )
    return ranked.agg(*picks).select(F.explode(rows).alias("_row")).select("_row.*")


def per_minute(df: DataFrame, time: str, labels: Sequence[str] = ()) -> DataFrame:
    """Rows per label and minute of an epoch-ms column: the base of every rate."""
    return (
        df.withColumn("minute", F.expr(f"`{time}` div {MINUTE_MS}L"))
        .groupBy(*labels, "minute")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def windowed_rate(
    df: DataFrame, time: str, labels: Sequence[str] = (), minutes: int = 5
) -> DataFrame:
    """Increase and per-second rate over sliding windows that end at each full minute.

    Minutes are counted first; only those counts are copied into the windows they belong to.
    """
    ends = F.explode(F.sequence(F.col("minute") + 1, F.col("minute") + minutes))
    return (
        per_minute(df, time, labels)
        .withColumn("_end", ends)
        .groupBy(*labels, "_end")
        .agg(F.sum("n").alias("increase"))
        .select(
            *labels,
            (F.col("_end") * MINUTE_MS).alias("window_end"),
            "increase",
            (F.col("increase") / (minutes * 60.0)).alias("rate"),
        )
    )


@dataclass(frozen=True)
class Alert:
    name: str
    severity: str
    limit: float
    hold_minutes: int  # how long the condition must have held


# Thresholds and hold times.
DLQ_EVENTS = Alert("DLQEventsDetected", "critical", 0.0, 0)
ENRICHMENT_LATENCY = Alert("EnrichmentLatencyHigh", "critical", 20.0, 5)
WATERMARK_STALL = Alert("WatermarkStalled", "warning", 60.0, 0)
CHECKPOINT_FAILURES = Alert("CheckpointFailures", "warning", 0.0, 0)
DLQ_DEPTH = Alert("DLQDepthNonZero", "page", 0.0, 0)
PUBLISH_LATENCY = Alert("ProducerLatencyHigh", "warning", 10.0, 1)
ERROR_RATE = Alert("ProducerErrorRateHigh", "warning", 0.01, 2)


def _held(values: DataFrame, alert: Alert) -> DataFrame:
    """(window_end, value) rows above the limit for the whole hold time, as alert rows."""
    firing = values.where(F.col("value") > alert.limit)
    recent = (
        Window.partitionBy(F.lit(0))
        .orderBy("window_end")
        .rangeBetween(-alert.hold_minutes * MINUTE_MS, 0)
    )
    return (
        firing.withColumn("_held", F.count(F.lit(1)).over(recent))
        .where(F.col("_held") == alert.hold_minutes + 1)
        .select(
            F.lit(alert.name).alias("alert"),
            F.lit(alert.severity).alias("severity"),
            "window_end",
            F.col("value").cast("double").alias("value"),
        )
    )


def event_alerts(dlq: DataFrame, time: str = "failed_at") -> DataFrame:
    """Any dead letter in the last minute."""
    counts = windowed_rate(dlq, time, minutes=1)
    return _held(counts.select("window_end", F.col("increase").alias("value")), DLQ_EVENTS)


def depth_alerts(dlq: DataFrame, time: str = "failed_at") -> DataFrame:
    """Dead letters so far, at each minute that added one: the depth only grows."""
    so_far = Window.partitionBy(F.lit(0)).orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    depth = per_minute(dlq, time).select(
        ((F.col("minute") + 1) * MINUTE_MS).alias("window_end"), F.sum("n").over(so_far).alias("value")
    )
    return _held(depth, DLQ_DEPTH)


def latency_alerts(
    df: DataFrame, latency: str, time: str, bounds: Sequence[int], alert: Alert, minutes: int = 5
) -> DataFrame:
    """Histogram p99 over sliding windows above the alert's limit."""
    names = [f"_le{i}" for i in range(len(bounds) + 1)]
    ends = F.explode(F.sequence(F.col("minute") + 1, F.col("minute") + minutes))
    wide = (
        df.withColumn("minute", F.expr(f"`{time}` div {MINUTE_MS}L"))
        .groupBy("minute")
        .agg(*_bucket_columns(F.col(latency), bounds))
        .withColumn("_end", ends)
        .groupBy("_end")
        .agg(*[F.sum(name).alias(name) for name in names])
    )
    rows = F.array(
        *[
            F.struct(F.lit(float(bound)).alias("le"), F.col(name).alias("cumulative"))
            for bound, name in zip([*bounds, float("inf")], names)
        ]
    )
    buckets = wide.select(
        (F.col("_end") * MINUTE_MS).alias("window_end"), F.explode(rows).alias("_row")
    ).select("window_end", "_row.*")
    p99 = histogram_quantiles(buckets, ["window_end"], [0.99])
    return _held(p99.select("window_end", "value"), alert)


def error_rate_alerts(errors: DataFrame, time: str) -> DataFrame:
    """Errors per second over five minutes above the limit."""
    rates = windowed_rate(errors, time, minutes=5)
    return _held(rates.select("window_end", F.col("rate").alias("value")), ERROR_RATE)


def stall_alerts(df: DataFrame, time: str) -> DataFrame:
    """Stretches of more than the limit without an event, by the minute that ended them.

    Only first and last time per minute are compared, which is enough to see every long gap.
    """
    minutes = (
        df.withColumn("minute", F.expr(f"`{time}` div {MINUTE_MS}L"))
        .groupBy("minute")
        .agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    )
    gap = F.col("_first") - F.lag("_last").over(Window.partitionBy(F.lit(0)).orderBy("minute"))
    gaps = minutes.select(F.col("_first").alias("window_end"), (gap / 1000.0).alias("value"))
    return _held(gaps, WATERMARK_STALL)


def failure_alerts(failures: DataFrame, time: str) -> DataFrame:
    """Failed checkpoints (here: failed micro-batches) in the last five minutes."""
    counts = windowed_rate(failures, time, minutes=5)
    return _held(counts.select("window_end", F.col("increase").alias("value")), CHECKPOINT_FAILURES)


def state_sizes(df: DataFrame) -> DataFrame:
    """Estimated live state as (store, entries, bytes), as of the last event time."""
    last = df.agg(F.max("event_time").alias("last")).scalar()
    recent = df.where(F.col("event_time") > last - 2 * DAY_MS)
    buckets = (
        df.where(F.col("event_time") > last - DAY_MS)
        .select("account_id", F.expr(f"event_time div {MINUTE_MS}L").alias("bucket"))
        .distinct()
        .agg(F.count(F.lit(1)).alias("entries"))
    )
    devices = (
        df.where(F.col("event_time") > last - 7 * 24 * HOUR_MS)
        .where(F.coalesce(F.col("api_key_id"), F.lit("")) != "")
        .select("api_key_id")
        .distinct()
        .agg(F.count(F.lit(1)).alias("entries"))
    )
    ids = recent.select("transaction_id").distinct().agg(F.count(F.lit(1)).alias("entries"))
    parts = [("velocity", buckets, BUCKET_BYTES), ("device", devices, DEVICE_BYTES), ("dedup", ids, DEDUP_BYTES)]
    tables = [
        table.select(
            F.lit(store).alias("store"), "entries", (F.col("entries") * size).alias("bytes")
        )
        for store, table, size in parts
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def version_mix(df: DataFrame) -> DataFrame:
    """Rows per masking library version."""
    return counter(df, ["masking_lib_version"], "events")


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float] = QUANTILES
) -> DataFrame:
    """Interpolated quantiles of an integer column per group: keys, ``events`` and ``_q``, in order.

    Rows are counted per distinct value before anything is sorted, so a group's window holds its
    distinct values, not its rows. Null keys are a group; a group of null values only has null quantiles.
    """
    counts = df.groupBy(*keys, F.col(value).cast("bigint").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    held = F.when(F.col("_value").isNotNull(), F.col("_n")).otherwise(0)
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumns({"_end": F.sum(held).over(upto), "_total": F.sum(held).over(group)})
    ranked = ranked.withColumn("_start", F.col("_end") - held)

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("_start") <= index) & (index < F.col("_end")), F.col("_value")))

    points = []
    for q in quantiles:
        place = F.lit(float(q)) * (F.col("_total") - 1)
        low, part = at(F.floor(place)), F.max(place - F.floor(place))
        points.append(low + (at(F.ceil(place)) - low) * part)
    return ranked.groupBy(*keys).agg(F.sum("_n").alias("events"), F.array(*points).alias("_q"))


def _skew() -> Column:
    return F.col("processing_time") - F.col("event_time")


def _by_name(df: DataFrame, key: str) -> DataFrame:
    return df.select(
        key, "events", *[F.get("_q", F.lit(i)).alias(f"skew_p{int(q * 100)}_ms") for i, q in enumerate(QUANTILES)]
    )


def clock_skew(df: DataFrame, key: str = "api_key_id") -> DataFrame:
    """Quantiles of processing minus event time per key.

    Accepted events lie within minutes of the receiving clock, so a key has few distinct values. Where
    clocks are not checked, ``clock_skew_sketched`` needs no more than a sketch per key.
    """
    return _by_name(grouped_quantiles(df.withColumn("_skew", _skew()), [key], "_skew"), key)


# Entries of a sketch. At 200 a quantile is off by at most 1.65 % of the ranks, with 99 % confidence
# (the error falls almost as 1 / SKETCH_K; a sketch holds some three times as many values).
SKETCH_K = 200
SKETCH_RANK_ERROR = 0.0165


def quantile_sketches(
    df: DataFrame, value: str, time: str, labels: Sequence[str] = (), k: int = SKETCH_K
) -> DataFrame:
    """A mergeable sketch of an integer column per label and minute, with its rows as ``n``.

    Null values are not counted. Keep this table where quantiles over many windows or long spans are
    wanted: windows merge sketches of a few hundred values and never see rows again.
    """
    return (
        df.where(F.col(value).isNotNull())
        .withColumn("minute", F.expr(f"`{time}` div {MINUTE_MS}L"))
        .groupBy(*labels, "minute")
        .agg(
            F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), k).alias("sketch"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def _sketched(quantiles: Sequence[float]) -> Column:
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    return F.kll_sketch_get_quantile_bigint("sketch", ranks)


def sliding_quantiles(
    sketches: DataFrame, labels: Sequence[str] = (), minutes: int = 5, quantiles: Sequence[float] = QUANTILES
) -> DataFrame:
    """Approximate quantiles over windows that end at each full minute, as ``values`` in order.

    Each value is one of the column's, its rank off by at most ``SKETCH_RANK_ERROR`` (see there). A window
    that holds no row is absent.
    """
    ends = F.explode(F.sequence(F.col("minute") + 1, F.col("minute") + minutes))
    return (
        sketches.withColumn("_end", ends)
        .groupBy(*labels, "_end")
        .agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("n").alias("n"))
        .select(
            *labels, (F.col("_end") * MINUTE_MS).alias("window_end"), "n", _sketched(quantiles).alias("values")
        )
    )


def clock_skew_sketched(df: DataFrame, key: str = "api_key_id", k: int = SKETCH_K) -> DataFrame:
    """``clock_skew`` in bounded memory per key, whatever the clocks: values with a rank error as stated there."""
    sketches = df.groupBy(key).agg(
        F.kll_sketch_agg_bigint(_skew(), k).alias("sketch"), F.count(F.lit(1)).alias("events")
    )
    return _by_name(sketches.withColumn("_q", _sketched(QUANTILES)), key)

"""Per-device history; the API key stands for the device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.config import DAY_MS, HOUR_MS, MINUTE_MS, SkewConfig
from tollgate.operators.skew import SLICE, running
from tollgate.operators.velocity import as_count
from tollgate.schemas import ARRIVAL, DEVICE

NO_DEVICE = "__no_device__"
IDLE_MS = 7 * DAY_MS
#: A run of one device's events without a gap longer than the idle limit.
SEGMENT = ("api_key_id", "first_seen", "last_seen", "cnt")


def device_key(api_key: Column) -> Column:
    """Key of a row's device; rows without one share a marker and get null features."""
    return F.when(api_key.isNull() | (api_key == ""), F.lit(NO_DEVICE)).otherwise(api_key)


def device_snapshot(df: DataFrame) -> DataFrame:
    """First and last event time and row count per device, over the whole table."""
    return (
        df.where(F.col("api_key_id").isNotNull() & (F.col("api_key_id") != ""))
        .groupBy("api_key_id")
        .agg(
            F.min("event_time").alias("device_first_seen"),
            F.count(F.lit(1)).alias("device_txn_count"),
            F.max("event_time").alias("device_last_seen"),
        )
    )


def _slot_ms(idle_ms: int) -> int:
    """Length of the slots of segments: no gap that ends a session fits into one."""
    for length in (DAY_MS, HOUR_MS, MINUTE_MS):
        if length <= idle_ms:
            return length
    raise ValueError(f"idle_ms must be a minute at least, not {idle_ms}")


def _with_spell(slots: DataFrame, idle_ms: int) -> DataFrame:
    """Number the sessions of each device. A slot's reach may go beyond the slots after it."""
    by_slot = Window.partitionBy("_device").orderBy("_slot")
    reached = F.max("_last_time").over(by_slot.rowsBetween(Window.unboundedPreceding, -1))
    back = F.when(F.col("_first_time") - reached > idle_ms, 1).otherwise(0)
    return slots.withColumn("_back", back).withColumn("_spell", F.sum("_back").over(by_slot)).drop("_back")


def segments(df: DataFrame, idle_ms: int = IDLE_MS) -> DataFrame:
    """Rows as segments of SEGMENT columns: first and last time and count per device and slot of time.

    Segments of any tables of rows, put together, have the sessions of all the rows, in whatever
    order they are joined.
    """
    return (
        df.where(device_key(F.col("api_key_id")) != NO_DEVICE)
        .groupBy("api_key_id", F.expr(f"event_time div {_slot_ms(idle_ms)}L").alias("_slot"))
        .agg(
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("last_seen"),
            F.count(F.lit(1)).alias("cnt"),
        )
        .drop("_slot")
    )


def sessions(
    parts: DataFrame, idle_ms: int = IDLE_MS, others: DataFrame | None = None, since: int | None = None
) -> DataFrame:
    """Segments joined to one for each session of their device.

    ``others`` are segments that may hold sessions together but do not come out. Sessions that ended
    before ``since``, those of ``others`` seen, are left out.
    """
    both = parts.withColumn("_own", F.lit(True))
    if others is not None:
        both = both.unionByName(others.withColumn("_own", F.lit(False)))
    own = F.col("_own")
    slots = both.groupBy(
        F.col("api_key_id").alias("_device"), F.expr(f"first_seen div {_slot_ms(idle_ms)}L").alias("_slot")
    ).agg(
        F.min("first_seen").alias("_first_time"),
        F.max("last_seen").alias("_last_time"),
        F.min(F.when(own, F.col("first_seen"))).alias("_own_first"),
        F.max(F.when(own, F.col("last_seen"))).alias("_own_last"),
        F.sum(F.when(own, F.col("cnt"))).alias("_own_cnt"),
    )
    joined = (
        _with_spell(slots, idle_ms)
        .groupBy("_device", "_spell")
        .agg(
            F.min("_own_first").alias("first_seen"),
            F.max("_own_last").alias("last_seen"),
            F.sum("_own_cnt").alias("cnt"),
            F.max("_last_time").alias("_end"),
        )
        .where(F.col("cnt").isNotNull())
    )
    if since is not None:
        joined = joined.where(F.col("_end") >= since)
    return joined.select(F.col("_device").alias("api_key_id"), *SEGMENT[1:])


def _history(table: DataFrame, idle_ms: int, held: DataFrame | None) -> DataFrame:
    """Per device and minute: what its session held before, and the earlier session that begins next.

    ``held`` are the device's earlier sessions. Minutes are joined to segments by slot, and only those
    are in order per device: a device has as many as slots with events, and its minutes are added up
    slot by slot. A session begun in a slot is one with all rows of the slot.
    """
    slot = F.expr(f"{SLICE} * {MINUTE_MS}L div {_slot_ms(idle_ms)}L")
    minutes = table.select("_device", SLICE, "_n", "_first_time", "_last_time").withColumn("_slot", slot)
    parts = minutes.select("_device", "_slot", "_n", F.lit(0).cast("bigint").alias("_held"), "_first_time", "_last_time")
    if held is not None:
        parts = parts.unionByName(
            held.select(
                F.col("api_key_id").alias("_device"),
                F.expr(f"first_seen div {_slot_ms(idle_ms)}L").alias("_slot"),
                F.lit(0).cast("bigint").alias("_n"),
                F.col("cnt").alias("_held"),
                F.col("first_seen").alias("_first_time"),
                F.col("last_seen").alias("_last_time"),
            )
        )
    slots = parts.groupBy("_device", "_slot").agg(
        F.sum("_n").alias("_n"),
        F.sum("_held").alias("_held"),
        F.min("_first_time").alias("_first_time"),
        F.max("_last_time").alias("_last_time"),
        F.min(F.when(F.col("_held") > 0, F.col("_first_time"))).alias("_held_first"),
    )
    spell = Window.partitionBy("_device", "_spell").orderBy("_slot")
    earlier = F.sum("_n").over(spell.rowsBetween(Window.unboundedPreceding, -1))
    upcoming = Window.partitionBy("_device").orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    begun = F.when(F.col("_held") > 0, F.struct("_held_first", "_held"))
    following = F.lit(None) if held is None else F.last(begun, ignorenulls=True).over(upcoming)
    none = "struct<_held_first:bigint,_held:bigint>"
    context = _with_spell(slots, idle_ms).select(
        "_device",
        "_slot",
        F.first("_first_time").over(spell).alias("_since"),
        (F.coalesce(earlier, F.lit(0)) + F.sum("_held").over(spell)).alias("_past"),
        following.cast(none).alias("_following"),
    )
    inside = Window.partitionBy("_device", "_slot").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = minutes.select("_device", "_slot", SLICE, F.coalesce(F.sum("_n").over(inside), F.lit(0)).alias("_before"))
    return before.join(context, ["_device", "_slot"]).select(
        "_device", SLICE, "_since", (F.col("_past") + F.col("_before")).alias("_past"), "_following"
    )


def device_profile(
    df: DataFrame,
    skew: SkewConfig | None = None,
    idle_ms: int = IDLE_MS,
    arrival: Sequence[str] = ARRIVAL,
    base: DataFrame | None = None,
    held: DataFrame | None = None,
) -> DataFrame:
    """Add first-seen time, running count and fraud flag of each row's device.

    The profile starts anew after more than ``idle_ms`` without an event. No label feed exists,
    so the flag is false wherever a device is known. ``base`` may name a cheaper table with the
    same rows.

    ``held`` are ``sessions`` of rows that came before all of these, one segment for each. A row is
    part of the session that they and the rows up to it, by event time, make of its device: one that
    falls between two earlier sessions, idle_ms from either at most, counts both.
    """
    keyed = {"_device": device_key(F.col("api_key_id"))}
    run = running(
        df.withColumns(keyed),
        ["_device"],
        "event_time",
        arrival,
        {},
        lambda table: _history(table, idle_ms, held),
        skew or SkewConfig(),
        base=(df if base is None else base).withColumns(keyed),
    )
    known = F.col("_device") != NO_DEVICE
    following = F.col("_following")
    reached = following["_held_first"] - F.col("event_time") <= idle_ms
    past = F.col("_past") + F.when(reached, following["_held"]).otherwise(0)
    return run.withColumns(
        {
            "device_first_seen": F.when(known, F.col("_since")),
            "device_txn_count": F.when(known, as_count(past + F.col("_n"))),
            "device_known_fraud": F.when(known, F.lit(False)),
        }
    ).select(*df.columns, *DEVICE.fieldNames())

"""Drop repeated transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.config import HOUR_MS
from tollgate.schemas import ARRIVAL
from tollgate.session import fresh_path, write_durable

TTL_MS = 48 * HOUR_MS
ID = "transaction_id"
_SALTS = 16
_WHOLE_STEPS = 3


def first_per_id(df: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Keep the first row per transaction id.

    The row-number filter also runs before the shuffle, so a task sends at most one row per id,
    however many copies it holds.
    """
    order = Window.partitionBy(ID).orderBy("event_time", *arrival)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def dedup(
    df: DataFrame,
    ttl_ms: int = TTL_MS,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Keep a row unless its id was already kept less than ``ttl_ms`` before.

    Only ids whose copies span the ttl can have a second kept row. They are found by one small
    aggregate; if there are none the first row per id is the answer.
    """
    first = first_per_id(df, arrival)
    spans = df.groupBy(ID).agg(
        F.min("event_time").alias("_first"), F.max("event_time").alias("_last")
    )
    wide = write_durable(
        spans.where(F.col("_last") - F.col("_first") >= ttl_ms).select(
            ID, (F.col("_first") + ttl_ms).alias("_open_from")
        ),
        "dedup-open",
    )
    if wide.isEmpty():
        return first
    again = _kept_again(df, wide, ttl_ms, arrival)
    return first.unionByName(df.join(again, [ID, "event_time", *arrival], "left_semi"))


def _with_open_from(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows at or after their id's open time. The salt spreads the copies of a hot id."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    return (
        rows.withColumn("_salt", F.pmod(F.hash("event_time"), F.lit(_SALTS)))
        .join(state.select(ID, "_open_from", salts.alias("_salt")), [ID, "_salt"])
        .where(F.col("event_time") >= F.col("_open_from"))
    )


def _kept_again(
    df: DataFrame, wide: DataFrame, ttl_ms: int, arrival: Sequence[str]
) -> DataFrame:
    """Later kept rows as (id, event_time, arrival).

    Each step keeps the earliest open row per id, one minimum with map-side combine. The first
    steps look at all rows, which is all it takes unless an id comes back many times. After them
    one step per slice of ``ttl_ms`` finishes the rest: an id is kept at most once in a slice, so
    each row is read once more. The driver holds slice numbers, nothing else.
    """
    spark = df.sparkSession
    state = wide
    # Copies of one id at one moment collapse here; a hot id spreads over its moments.
    moments = (
        _with_open_from(df.select(ID, "event_time", *arrival), state)
        .groupBy(ID, "event_time")
        .agg(F.min(F.struct(*arrival)).alias("_arrival"))
        .withColumn("_step", F.expr(f"event_time div {ttl_ms}L"))
        .hint("rebalance", "_step")
    )
    moments = write_durable(moments, "dedup-copies", "_step")
    root = fresh_path(spark, "dedup-steps")

    def advance(rows: DataFrame, number: int) -> DataFrame:
        earliest = (
            _with_open_from(rows, state)
            .groupBy(ID)
            .agg(F.min(F.struct("event_time", "_arrival")).alias("_kept"))
        )
        after = state.select(ID, "_open_from").join(earliest, ID, "left").select(
            ID,
            F.coalesce(F.col("_kept.event_time") + ttl_ms, F.col("_open_from")).alias("_open_from"),
            "_kept",
        )
        path = f"{root}/_number={number}"
        after.write.parquet(path)
        return spark.read.schema(after.schema).parquet(path)

    for number in range(_WHOLE_STEPS):
        state = advance(moments, number)
        if state.where(F.col("_kept").isNotNull()).isEmpty():
            break
    else:
        slices = moments.select("_step").distinct().toLocalIterator()
        for number, step in enumerate(sorted(row["_step"] for row in slices), _WHOLE_STEPS):
            state = advance(moments.where(F.col("_step") == step), number)
    kept = spark.read.schema(state.schema).parquet(root).where(F.col("_kept").isNotNull())
    return kept.select(ID, F.col("_kept.event_time").alias("event_time"), F.col("_kept._arrival.*"))


def latest_per_id(df: DataFrame) -> DataFrame:
    """Latest record per transaction id by enrichment time: what a reader of the output uses."""
    order = Window.partitionBy(ID).orderBy(F.desc("enrichment_time"))
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")

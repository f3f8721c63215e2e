"""Running values over ordered groups of any size, and joins that survive a hot key.

A window over one key puts that key's rows on one task. Here a group is cut into time slices
first: sums per slice come from a map-side combined aggregate, only those small slice tables are
windowed per key (their size is bounded by time, not by rows), and the rows themselves are
windowed inside one slice. A slice that is hot is cut again, by its millisecond and by blocks of
its arrival order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.config import MINUTE_MS, SkewConfig

SLICE = "_slice"
_SUB = ("_sub_time", "_sub_part", "_sub_block")


def hot_keys(counts: DataFrame, keys: Sequence[str], cfg: SkewConfig, rows: DataFrame) -> DataFrame:
    """Keys above the hot limit: at most 1 / hot_share of them, so the result may be broadcast.

    ``counts`` has ``_n`` per key; ``rows`` is the table counted, for its total.
    """
    share = rows.agg((F.count(F.lit(1)) * cfg.hot_share).cast("bigint").alias("limit")).scalar()
    return counts.where(F.col("_n") > F.greatest(F.lit(cfg.hot_rows), share)).select(*keys)


def slices(
    df: DataFrame, keys: Sequence[str], time: str, sums: dict[str, Column], slice_ms: int = MINUTE_MS
) -> DataFrame:
    """Per key and time slice: row count, sums, first and last time."""
    return (
        df.withColumn(SLICE, F.expr(f"`{time}` div {slice_ms}L"))
        .groupBy(*keys, SLICE)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.sum(value).alias(name) for name, value in sums.items()],
            F.min(time).alias("_first_time"),
            F.max(time).alias("_last_time"),
        )
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    arrival: Sequence[str],
    sums: dict[str, Column],
    context: Callable[[DataFrame], DataFrame],
    cfg: SkewConfig,
    slice_ms: int = MINUTE_MS,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add running values within each (key, slice), and per-slice context columns.

    Rows run in (time, arrival) order; ``arrival`` is (partition, offset), unique per row. Keys
    and time must not be null.
    Adds ``_n`` (row number in the slice) and one running sum per entry of ``sums``; ``context``
    gets the slice table and returns (keys, slice, more columns), which every row of the slice
    receives. ``_slice`` stays in the result. ``base`` may name a cheaper table with the same rows
    (and at least the key, time, arrival and sum columns) to compute the slice tables from.
    """
    part, offset = arrival
    keys = list(keys)
    base = df if base is None else base
    table = slices(base, keys, time, sums, slice_ms)
    hot = hot_keys(table, [*keys, SLICE], cfg, base).withColumn("_hot", F.lit(True))
    block = F.expr(f"`{offset}` div {cfg.block_rows}L")
    none = F.lit(-1).cast("bigint")

    def tag(rows: DataFrame) -> DataFrame:
        return (
            rows.withColumn(SLICE, F.expr(f"`{time}` div {slice_ms}L"))
            .join(F.broadcast(hot), [*keys, SLICE], "left")
            .withColumns(
                {
                    "_sub_time": F.when(F.col("_hot"), F.col(time)).otherwise(none),
                    "_sub_part": F.when(F.col("_hot"), F.col(part)).otherwise(none).cast("bigint"),
                    "_sub_block": F.when(F.col("_hot"), block).otherwise(none),
                }
            )
        )

    # Totals of the earlier chunks of the same hot slice.
    before = Window.partitionBy(*keys, SLICE).orderBy(*_SUB).rowsBetween(
        Window.unboundedPreceding, -1
    )
    chunks = (
        tag(base)
        .where(F.col("_hot"))
        .groupBy(*keys, SLICE, *_SUB)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.sum(value).alias(name) for name, value in sums.items()],
        )
        .select(
            *keys,
            SLICE,
            *_SUB,
            *[
                F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"_before_{name}")
                for name in ["_n", *sums]
            ],
        )
    )
    per_chunk = context(table).join(chunks, [*keys, SLICE], "left").withColumns(
        {name: F.coalesce(F.col(name), none) for name in _SUB}
    )

    inside = Window.partitionBy(*keys, SLICE, *_SUB).orderBy(time, part, offset).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = tag(df).drop("_hot").withColumns(
        {"_n": F.count(F.lit(1)).over(inside)}
        | {name: F.sum(value).over(inside) for name, value in sums.items()}
    )
    joined = local.join(per_chunk, [*keys, SLICE, *_SUB])
    return joined.withColumns(
        {
            name: F.col(name) + F.coalesce(F.col(f"_before_{name}"), F.lit(0))
            for name in ["_n", *sums]
        }
    ).drop(*_SUB, *[f"_before_{name}" for name in ["_n", *sums]])


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    cfg: SkewConfig,
    counts: DataFrame | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """Left join of many rows to at most one lookup row per key, with hot keys salted.

    ``counts`` has rows per key as ``_n`` (default: counted here); ``base`` may name a cheaper
    table with the same rows to count. Rows of a hot key spread over
    ``cfg.salts`` tasks by their ``spread`` columns, as do rows without a key; the lookup row of a
    hot key is repeated.
    """
    keys = list(keys)
    if counts is None:
        counts = (rows if base is None else base).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = hot_keys(counts, keys, cfg, rows if base is None else base)
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    salt = F.pmod(F.hash(*spread), F.lit(cfg.salts))
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    salted_rows = rows.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | keyless, salt).otherwise(F.lit(0))
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(cfg.salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_lookup = lookup.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted_rows.drop("_hot").join(salted_lookup, [*keys, "_salt"], "left").drop("_salt")

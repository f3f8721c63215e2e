"""Per-account transaction counts and amounts over 1 m, 5 m, 1 h and 24 h, current row included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.config import MINUTE_MS, SkewConfig
from tollgate.operators.skew import SLICE, lookup_join, running
from tollgate.schemas import ARRIVAL, VELOCITY, VELOCITY_WINDOWS

ACCOUNT = ("account_id",)
_MAX_INT = 2**31 - 1
_MAX_MONEY = "99999999999999.9999"


def as_count(value: Column) -> Column:
    """Contract int; null where the count is beyond it, which ``enrich`` turns into a dead letter."""
    return F.when(value <= _MAX_INT, value).cast("int")


def as_money(value: Column) -> Column:
    """Contract decimal(18,4); null where the amount is beyond it."""
    limit = F.lit(_MAX_MONEY).cast("decimal(38,4)")
    return F.when(F.abs(value) <= limit, value).cast("decimal(18,4)")


def minute_partials(df: DataFrame, keys: Sequence[str] = ACCOUNT) -> DataFrame:
    """Count and amount per key and minute bucket of event time."""
    return (
        df.withColumn("bucket", F.expr(f"event_time div {MINUTE_MS}L"))
        .groupBy(*keys, "bucket")
        .agg(F.count(F.lit(1)).alias("cnt"), F.sum("amount").alias("amount_sum"))
    )


def _window_sums(table: DataFrame, keys: Sequence[str], first: int) -> DataFrame:
    """Per slice and window of m minutes: totals of slices [s - m + first, s - 1].

    Each total is the difference of two growing frames, which Spark updates row by row; a
    sliding frame would add up its whole content for every row.
    """
    ordered = Window.partitionBy(*keys).orderBy(SLICE)

    def upto(name: str, last: int) -> Column:
        total = F.sum(name).over(ordered.rangeBetween(Window.unboundedPreceding, last))
        return F.coalesce(total, F.lit(0))

    columns = {}
    for label, minutes in VELOCITY_WINDOWS:
        for name in ("_n", "_amount"):
            columns[f"_past{name}_{label}"] = upto(name, -1) - upto(name, -minutes + first - 1)
    return table.select(*keys, SLICE, *[value.alias(name) for name, value in columns.items()])


def velocity(
    df: DataFrame,
    skew: SkewConfig | None = None,
    mode: str = "bucket",
    keys: Sequence[str] = ACCOUNT,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Add the eight velocity columns; one beyond its contract type is null.

    ``mode="bucket"`` counts whole minute buckets from m minutes before the row's own bucket, up
    to the row itself in (event_time, arrival) order. ``mode="exact"`` counts event times in
    (t - window, t], where rows with the same event time see each other.
    """
    if mode == "bucket":
        return _bucket_velocity(df, skew or SkewConfig(), keys, arrival)
    if mode == "exact":
        return _exact_velocity(df, skew or SkewConfig(), keys, arrival)
    raise ValueError(f"unknown velocity mode: {mode!r}")


def velocity_by_currency(df: DataFrame, skew: SkewConfig | None = None, mode: str = "bucket") -> DataFrame:
    """Velocity per account and currency, so amounts of different currencies are never added."""
    return velocity(df, skew, mode, keys=("account_id", "currency"))


def _finish(df: DataFrame, count: dict[str, Column], amount: dict[str, Column]) -> DataFrame:
    columns = {}
    for label, _ in VELOCITY_WINDOWS:
        columns[f"vel_count_{label}"] = as_count(count[label])
        columns[f"vel_amount_{label}"] = as_money(amount[label])
    return df.withColumns({name: columns[name] for name in VELOCITY.fieldNames()})


def _bucket_velocity(
    df: DataFrame, skew: SkewConfig, keys: Sequence[str], arrival: Sequence[str]
) -> DataFrame:
    run = running(
        df,
        keys,
        "event_time",
        arrival,
        {"_amount": F.col("amount")},
        lambda table: _window_sums(table, keys, first=0),
        skew,
    )
    labels = [label for label, _ in VELOCITY_WINDOWS]
    return _finish(
        run,
        {label: F.col("_n") + F.col(f"_past_n_{label}") for label in labels},
        {label: F.col("_amount") + F.col(f"_past_amount_{label}") for label in labels},
    ).select(*df.columns, *VELOCITY.fieldNames())


def _exact_velocity(
    df: DataFrame, skew: SkewConfig, keys: Sequence[str], arrival: Sequence[str]
) -> DataFrame:
    """(t - m minutes, t] = later part of minute b - m, whole minutes between, start of minute b.

    Every event therefore plays a part in five minutes: its own and the ones m minutes later.
    Rows are first added up per millisecond, so a (key, minute) group has at most 60,000 rows.
    """
    keys = list(keys)
    moments = df.groupBy(*keys, "event_time").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_amount")
    )
    parts = [("own", 0), *VELOCITY_WINDOWS]
    placed = (
        moments.withColumn(
            "_part",
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(label).alias("label"), F.lit(minutes).alias("shift"))
                        for label, minutes in parts
                    ]
                )
            ),
        )
        .withColumn("_at", F.col("event_time") + F.col("_part.shift").cast("bigint") * MINUTE_MS)
        .groupBy(*keys, "_at")
        .agg(
            *[
                F.sum(F.when(F.col("_part.label") == label, F.col(name))).alias(f"{name}_{label}")
                for label, _ in parts
                for name in ("_n", "_amount")
            ]
        )
        .withColumn(SLICE, F.expr(f"_at div {MINUTE_MS}L"))
    )
    minute = Window.partitionBy(*keys, SLICE).orderBy("_at")
    upto_now = minute.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = minute.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def later(name: str) -> Column:
        so_far = F.coalesce(F.sum(name).over(upto_now), F.lit(0))
        return F.coalesce(F.sum(name).over(whole), F.lit(0)) - so_far

    edges = placed.select(
        *keys,
        SLICE,
        "_at",
        "_n_own",
        *[F.sum(f"{name}_own").over(upto_now).alias(f"{name}_tail") for name in ("_n", "_amount")],
        *[
            later(f"{name}_{label}").alias(f"{name}_head_{label}")
            for label, _ in VELOCITY_WINDOWS
            for name in ("_n", "_amount")
        ],
    ).where(F.col("_n_own").isNotNull())
    minutes = (
        moments.withColumn(SLICE, F.expr(f"event_time div {MINUTE_MS}L"))
        .groupBy(*keys, SLICE)
        .agg(F.sum("_n").alias("_n"), F.sum("_amount").alias("_amount"))
    )
    between = _window_sums(minutes, keys, first=1)
    at_time = edges.join(between, [*keys, SLICE])
    labels = [label for label, _ in VELOCITY_WINDOWS]

    def total(name: str, label: str) -> Column:
        return F.col(f"{name}_head_{label}") + F.col(f"_past{name}_{label}") + F.col(f"{name}_tail")

    features = _finish(
        at_time.withColumn("event_time", F.col("_at")),
        {label: total("_n", label) for label in labels},
        {label: total("_amount", label) for label in labels},
    ).select(*keys, "event_time", *VELOCITY.fieldNames())
    return lookup_join(
        df, features, [*keys, "event_time"], arrival, skew, counts=moments
    ).select(*df.columns, *VELOCITY.fieldNames())

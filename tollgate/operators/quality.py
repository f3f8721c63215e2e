"""Contract checks, invariants, reconciliation, corrections and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.config import DAY_MS, MINUTE_MS, SkewConfig
from tollgate.operators.dedup import ID, latest_per_id
from tollgate.operators.skew import lookup_join
from tollgate.operators.velocity import velocity
from tollgate.schemas import ARRIVAL, FORBIDDEN_FIELDS, VELOCITY, VELOCITY_WINDOWS
from tollgate.session import write_durable


def schema_differences(actual: T.StructType, contract: T.StructType) -> list[str]:
    """What is wrong with a schema, in words; empty when it keeps the contract."""
    found = [f"forbidden column {name}" for name in FORBIDDEN_FIELDS if name in actual.fieldNames()]
    if actual.fieldNames() != contract.fieldNames():
        missing = [n for n in contract.fieldNames() if n not in actual.fieldNames()]
        extra = [n for n in actual.fieldNames() if n not in contract.fieldNames()]
        found += [f"missing column {n}" for n in missing] + [f"unknown column {n}" for n in extra]
        if not missing and not extra:
            found.append("columns are out of order")
    for field in contract.fields:
        if field.name in actual.fieldNames() and actual[field.name].dataType != field.dataType:
            found.append(
                f"column {field.name} is {actual[field.name].dataType.simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    return found


def _counted(df: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """One pass over the rows: violations per (rule, column)."""
    totals = df.agg(
        *[
            F.coalesce(F.sum(F.when(broken, 1).otherwise(0)), F.lit(0)).alias(f"r{i}")
            for i, (_, _, broken) in enumerate(rules)
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column_name"),
                F.col(f"r{i}").cast("bigint").alias("violations"),
            )
            for i, (rule, column, _) in enumerate(rules)
        ]
    )
    return totals.select(F.explode(rows).alias("_row")).select("_row.*")


def contract_violations(
    df: DataFrame, contract: T.StructType, enums: dict[str, tuple[str, ...]]
) -> DataFrame:
    """Nulls in required columns and values outside an enum's domain, counted per column."""
    rules = [("required", f.name, F.col(f.name).isNull()) for f in contract.fields if not f.nullable]
    rules += [
        ("domain", name, ~F.col(name).isin(*domain))
        for name, domain in enums.items()
        if name in contract.fieldNames()
    ]
    return _counted(df, rules)


def pii_audit(df: DataFrame) -> DataFrame:
    """Card-number-length digit runs per string column, and IPv4 subnets that keep a host part."""
    rules = [
        ("digit_run", f.name, F.col(f.name).rlike("[0-9]{15,19}"))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    ]
    if "caller_ip_subnet" in df.columns:
        subnet = F.col("caller_ip_subnet")
        rules.append(("host_part", "caller_ip_subnet", subnet.contains(".") & ~subnet.endswith(".0")))
    return _counted(df, rules)


def invariant_violations(enriched: DataFrame) -> DataFrame:
    """Rows that break a feature rule, as (transaction_id, rule)."""
    labels = [label for label, _ in VELOCITY_WINDOWS]
    rules = []
    for label in labels:
        rules.append((f"vel_count_{label} >= 1", F.col(f"vel_count_{label}") < 1))
        rules.append((f"vel_amount_{label} > 0", F.col(f"vel_amount_{label}") <= 0))
    for short, long in zip(labels, labels[1:]):
        rules.append(
            (
                f"vel_count_{short} <= vel_count_{long}",
                F.col(f"vel_count_{short}") > F.col(f"vel_count_{long}"),
            )
        )
    rules.append(
        ("device_first_seen <= event_time", F.col("device_first_seen") > F.col("event_time"))
    )
    rules.append(("device_txn_count >= 1", F.col("device_txn_count") < 1))
    broken = F.array_except(
        F.array(*[F.when(bad, F.lit(rule)) for rule, bad in rules]),
        F.array(F.lit(None).cast("string")),
    )
    return enriched.select("transaction_id", F.explode(broken).alias("rule"))


def reconcile(inputs: DataFrame, enriched: DataFrame, dlq: DataFrame) -> DataFrame:
    """Every input id should be on exactly one side, once.

    The three id lists go through one aggregate, so copies of a hot id collapse before the
    shuffle; there is no join.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("transaction_id").isNotNull()).select(
            "transaction_id",
            *[
                F.lit(1 if name == other else 0).alias(other)
                for other in ("n_input", "n_enriched", "n_dlq")
            ],
        )

    tallies = (
        side(inputs, "n_input")
        .unionByName(side(enriched, "n_enriched"))
        .unionByName(side(dlq, "n_dlq"))
        .groupBy("transaction_id")
        .agg(*[F.sum(n).alias(n) for n in ("n_input", "n_enriched", "n_dlq")])
    )
    out = F.col("n_enriched") + F.col("n_dlq")
    status = (
        F.when(F.col("n_input") == 0, "unexpected")
        .when(out == 0, "missing")
        .when((F.col("n_enriched") > 0) & (F.col("n_dlq") > 0), "both")
        .when(out > 1, "duplicate")
        .otherwise("ok")
    )
    return tallies.withColumn("status", status)


def missing_outputs(inputs: DataFrame, enriched: DataFrame, dlq: DataFrame) -> DataFrame:
    """Input ids that reached neither side."""
    return (
        reconcile(inputs, enriched, dlq).where(F.col("status") == "missing").select("transaction_id")
    )


def stage_correlation(events: DataFrame, enriched: DataFrame) -> DataFrame:
    """Hop latency per transaction: first arrival to first enrichment.

    Both sides are reduced to one row per id first, so the join has no hot key.
    """
    published = events.groupBy("transaction_id").agg(
        F.min("processing_time").alias("published_at"), F.count(F.lit(1)).alias("arrivals")
    )
    finished = enriched.groupBy("transaction_id").agg(
        F.min("enrichment_time").alias("enriched_at")
    )
    return published.join(finished, "transaction_id").withColumn(
        "hop_ms", F.col("enriched_at") - F.col("published_at")
    )


def event_day(time: Column) -> Column:
    """Day number of an epoch-ms time: the partition column of tables stored by day."""
    return F.floor(time / F.lit(DAY_MS)).cast("bigint")


# Up to this many days are broadcast to prune by: some 270 years, 1.6 MB.
LISTED_DAYS = 100_000


def on_days(table: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """Rows of a table stored by day that lie on one of ``days``.

    The span of the days is a plain partition filter. Inside it the list, broadcast if it is short
    enough, prunes at run time: folders of other days are not opened.
    """
    first, last, number = days.agg(F.min(day), F.max(day), F.count_distinct(day)).first()
    if first is None:
        return table.where(F.lit(False))
    within = F.col(day).between(first, last)
    listed = days.select(day).distinct().where(within)
    if number <= LISTED_DAYS:
        listed = F.broadcast(listed)
    return table.where(within).join(listed, day, "left_semi")


def _changed() -> Column:
    """Whether a velocity column differs from its new value."""
    changed = F.lit(False)
    for name in VELOCITY.fieldNames():
        changed = changed | ~F.col(name).eqNullSafe(F.col(f"_new_{name}"))
    return changed


def corrections_by_day(
    events: DataFrame,
    emitted: DataFrame,
    late: DataFrame,
    enrichment_time: Column,
    day: str = "event_day",
    skew: SkewConfig | None = None,
) -> DataFrame:
    """``corrections`` over tables stored in folders by ``day`` (``event_day`` of the event time).

    A late row changes its account's rows of the next 24 hours and a minute, so it touches at most
    three days of that account. Only those days of ``emitted`` are read, and of ``events`` those and
    the two days before, from which the windows of the first one reach back.

    A transaction here is an id and its event time: an id that came back after the dedup ttl counts as
    two, and its earlier record is corrected as well. The last record of each by ``enrichment_time`` is
    compared; readers take the last one per id and event time. Late rows without time or account touch
    nothing. No late row: no correction, and neither table is read.
    """
    skew = skew or SkewConfig()
    reach = DAY_MS + MINUTE_MS
    time = F.col("event_time")
    days = F.sequence(event_day(time), event_day(time + reach))
    touched = late.where(F.col("account_id").isNotNull()).select("account_id", F.explode(days).alias(day))
    touched = write_durable(touched.distinct(), "touched-days")
    back = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("_back")
    context = touched.select("account_id", day, back).groupBy(
        "account_id", (F.col(day) - F.col("_back")).alias(day)
    ).agg(F.min("_back").alias("_back"))
    context = write_durable(context, "context-days")
    keys = ["account_id", day]
    # Salted: a hot account's day must not meet on one task here.
    near = lookup_join(
        on_days(events, context, day).select(ID, *keys, "event_time", "amount", *ARRIVAL),
        context,
        keys,
        ARRIVAL,
        skew,
    ).where(F.col("_back").isNotNull())
    near = write_durable(near, "near")  # velocity reads it more than once
    fresh = velocity(near, skew).where(F.col("_back") == 0).select(
        ID, "event_time", *[F.col(name).alias(f"_new_{name}") for name in VELOCITY.fieldNames()]
    )
    pairs = on_days(emitted, touched, day).join(fresh, [ID, "event_time"])
    newest = Window.partitionBy(ID, "event_time").orderBy(F.desc("enrichment_time"))
    pairs = pairs.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1")
    return pairs.where(_changed()).withColumns(
        {name: F.col(f"_new_{name}") for name in VELOCITY.fieldNames()} | {"enrichment_time": enrichment_time}
    ).select(*emitted.columns)


def corrections(
    events: DataFrame,
    emitted: DataFrame,
    late: DataFrame,
    enrichment_time: Column,
    skew: SkewConfig | None = None,
) -> DataFrame:
    """Emitted records whose velocity a late arrival has changed, with new values and stamp.

    ``events`` are all unique transactions including the late ones, ``late`` the late ones; the
    latest emitted record of an id is the one to compare with. Only
    the accounts touched, and of them only the time a late row can reach, are computed again.
    Append the result; readers take the latest record per id.
    """
    reach = DAY_MS + MINUTE_MS
    spans = late.groupBy("account_id").agg(
        F.min("event_time").alias("_from"), F.max("event_time").alias("_to")
    )
    near = F.col("event_time").between(F.col("_from") - reach, F.col("_to") + reach)
    # Salted: a hot account's rows must not meet on one task here.
    touched = lookup_join(events, spans, ["account_id"], ARRIVAL, skew or SkewConfig()).where(near)
    names = VELOCITY.fieldNames()
    fresh = velocity(touched, skew).where(F.col("event_time") >= F.col("_from")).select(
        "transaction_id",
        F.col("event_time").alias("_event_time"),
        *[F.col(name).alias(f"_new_{name}") for name in names],
    )
    pairs = latest_per_id(emitted).join(fresh, "transaction_id").where(
        F.col("event_time") == F.col("_event_time")
    )
    return pairs.where(_changed()).withColumns(
        {name: F.col(f"_new_{name}") for name in names} | {"enrichment_time": enrichment_time}
    ).select(*emitted.columns)

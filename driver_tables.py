"""The driver's tables as payment data, for the registered queries, the bench and tests.

Each transform here has a twin in ``driver_sql.py``. Everything derives from columns of the
given tables by fixed rules, so both engines see the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators.geo import network_blocks

# Pools the transform picks from.
CURRENCIES = ["USD", "EUR", "GBP", "BRL", "MXN"]
# Full callers' addresses; the last two may not be stored.
ADDRESSES = [
    "203.0.113.45",
    "203.0.113.7",
    "198.51.100.20",
    "8.8.8.1",
    "1.1.1.1",
    "185.60.216.35",
    "104.16.0.1",
    "10.20.30.40",
    "2001:db8:1:2:a:b:c:d",
    "2001:db8::1",
    "224.0.0.5",
    "300.1.1.1",
]
# The same addresses cut to /24 and /64.
SUBNETS = [
    "203.0.113.0",
    "203.0.113.0",
    "198.51.100.0",
    "8.8.8.0",
    "1.1.1.0",
    "185.60.216.0",
    "104.16.0.0",
    "10.20.30.0",
    "2001:db8:1:2::",
    "2001:db8::",
    None,
    None,
]
STORABLE = 10
CARDS = [
    "4111111111111111",
    "378282246310005",
    "5500-0055-5555-5559",
    "4111 1111 1111 1111",
    "5500005555555559",
    "1234567890123456",
    "41111111111",
    "4111x11111111111",
]
CHANNELS = {"view": "WEB", "click": "MOBILE", "purchase": "POS", "signup": "API", "error": "FAX"}
# (network, country, city), nested on purpose.
BLOCKS = [
    ("203.0.0.0/8", "AU", None),
    ("203.0.113.0/24", "US", "New York"),
    ("198.51.0.0/16", "NL", "Amsterdam"),
    ("8.0.0.0/8", "US", None),
    ("8.8.8.0/24", "US", "Mountain View"),
    ("8.8.8.1/32", "US", "Palo Alto"),
    ("1.1.0.0/16", "AU", "Sydney"),
    ("185.60.0.0/16", "IE", None),
    ("185.60.216.0/22", "IE", "Dublin"),
    ("2001:db8::/32", "DE", None),
    ("2001:db8:1::/48", "DE", "Berlin"),
]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list, index: Column) -> Column:
    """values[index]; the pool is written out, so null entries are allowed."""
    items = F.array(*[F.lit(value).cast("string") for value in values])
    return F.get(items, index.cast("int"))


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp without zone, whatever the session's zone is."""
    span = ts - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    seconds = F.extract(F.lit("SECOND"), span)
    minutes = (
        F.extract(F.lit("DAY"), span) * 1440
        + F.extract(F.lit("HOUR"), span) * 60
        + F.extract(F.lit("MINUTE"), span)
    )
    return minutes.cast("bigint") * 60_000 + F.floor(seconds * 1000).cast("bigint")


START_MS = 1_704_067_200_000
HOUR_MS = 3_600_000
# Repeats of every n-th event: (n, delay in ms, step in the arrival order).
REPEATS = [
    (25, 0, 1),
    (40, 48 * HOUR_MS - 1, 2),
    (60, 48 * HOUR_MS, 3),
    (70, 30 * HOUR_MS, 4),
    (70, 60 * HOUR_MS, 5),
]


NEAR_REPEATS = REPEATS[:1]


def transactions(
    spark: SparkSession,
    sf_dir: str,
    squeeze: int = 1,
    repeats: list[tuple[int, int, int]] = REPEATS,
    late: bool = True,
) -> DataFrame:
    """Decoded transactions with source coordinates, from ``events``.

    ``squeeze`` divides the distance from the start of 2024, so that short windows fill up.
    ``repeats`` are added as above. With ``late`` every 50th event arrives late in its partition.
    """
    id_ = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    names = F.array(*[F.lit(name) for name in CHANNELS])
    since = epoch_ms(F.col("ts")) - START_MS
    copies = F.array(
        F.struct(F.lit(0).cast("bigint").alias("delay"), F.lit(0).alias("step")),
        *[
            F.when(
                id_ % every == 0,
                F.struct(F.lit(delay).cast("bigint").alias("delay"), F.lit(step).alias("step")),
            )
            for every, delay, step in repeats
        ],
    )
    events = (
        read(spark, sf_dir, "events")
        .withColumn("_since", since)
        .withColumn("_event_time", F.lit(START_MS) + F.expr(f"_since div {squeeze}L"))
        .withColumn("_again", F.explode(copies))
        .where(F.col("_again").isNotNull())
        .withColumn("event_time", F.col("_event_time") + F.col("_again.delay"))
    )
    return events.select(
        F.concat(F.lit("txn-"), id_.cast("string")).alias("transaction_id"),
        F.concat(F.lit("acc-"), F.col("user_id").cast("string")).alias("account_id"),
        F.concat(F.lit("merch-"), (id_ % 8).cast("string")).alias("merchant_id"),
        F.col("value").cast("decimal(18,4)").alias("amount"),
        pick(CURRENCIES, id_ % 5).alias("currency"),
        "event_time",
        (F.col("event_time") + 10 + id_ % 37).alias("processing_time"),
        pick(
            list(CHANNELS.values()), F.array_position(names, F.col("event_type")) - 1
        ).alias("channel"),
        F.lit("411111").alias("card_bin"),
        F.lit("1111").alias("card_last4"),
        pick(SUBNETS, (id_ * 7 + F.col("user_id")) % STORABLE).alias("caller_ip_subnet"),
        F.when(k % 20 != 0, F.concat(F.lit("key-"), (k % 5).cast("string"))).alias("api_key_id"),
        F.lit("transactions:write").alias("oauth_scope"),
        F.lit(None).cast("float").alias("geo_lat"),
        F.lit(None).cast("float").alias("geo_lon"),
        F.when(id_ % 10 == 0, "0.9.0").otherwise("1.0.0").alias("masking_lib_version"),
        F.lit("txn.api").alias("source_topic"),
        (F.col("user_id") % 12).cast("int").alias("source_partition"),
        (
            id_ * 10
            + F.when(F.lit(late) & (id_ % 50 == 0), 20_000).otherwise(0)
            + F.col("_again.step")
        ).alias("source_offset"),
    )


def enrichment_clock() -> Column:
    """A repeatable stand-in for the enrichment clock: 10 to 410 ms after processing."""
    return F.col("processing_time") + 10 + F.col("source_offset") * 13 % 401


def blocks(spark: SparkSession) -> DataFrame:
    def text(value: str | None) -> str:
        return "cast(null as string)" if value is None else f"'{value}'"

    rows = ", ".join(f"({', '.join(text(value) for value in row)})" for row in BLOCKS)
    return network_blocks(spark.sql(f"SELECT * FROM VALUES {rows} AS t(network, country, city)"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payloads from ``events``, with faults spread over all fields by fixed rules."""
    id_, user = F.col("event_id"), F.col("user_id")
    names = F.array(*[F.lit(name) for name in CHANNELS])
    text = F.col("value").cast("decimal(18,2)").cast("string")
    account = F.concat(F.lit("acc-"), user.cast("string"))
    return (
        read(spark, sf_dir, "events")
        .withColumn("_ms", epoch_ms(F.col("ts")))
        .select(
            F.when(id_ % 41 != 0, F.concat(F.lit("txn-"), id_.cast("string"))).alias("transaction_id"),
            F.when(id_ % 43 != 0, account).otherwise("").alias("account_id"),
            F.when(id_ % 47 == 0, F.lit("4000123412341234"))
            .otherwise(F.concat(F.lit("merch-"), (id_ % 8).cast("string")))
            .alias("merchant_id"),
            F.when(id_ % 31 == 0, F.lit("ten"))
            .when(id_ % 37 == 0, F.concat(F.lit("-"), text))
            .otherwise(text)
            .alias("amount"),
            F.when(id_ % 29 == 0, F.lit("US")).otherwise(pick(CURRENCIES, id_ % 5)).alias("currency"),
            F.when(id_ % 23 == 0, F.col("_ms") - 300_001).otherwise(F.col("_ms")).alias("event_time"),
            pick(
                list(CHANNELS.values()), F.array_position(names, F.col("event_type")) - 1
            ).alias("channel"),
            pick(CARDS, (id_ + user) % len(CARDS)).alias("card_number"),
            pick(ADDRESSES, (id_ * 7 + user) % len(ADDRESSES)).alias("caller_ip"),
            F.when(id_ % 53 != 0, F.concat(F.lit("key-"), (id_ % 5).cast("string"))).alias("api_key_id"),
            F.lit("transactions:write").alias("oauth_scope"),
            F.lit(None).cast("float").alias("geo_lat"),
            F.lit(None).cast("float").alias("geo_lon"),
            F.col("_ms").alias("received_at"),
        )
    )


LOG_SCHEMA_ID = 1


def log_records(rows: DataFrame, faults: bool = True) -> DataFrame:
    """Transactions as framed log records with JSON bodies.

    With ``faults`` some offsets carry a short frame, a wrong first byte, another schema id or a
    body that does not parse.
    """
    coordinates = ("source_topic", "source_partition", "source_offset")
    offset = F.col("source_offset")
    body = F.to_json(F.struct(*[c for c in rows.columns if c not in coordinates])).cast("binary")

    def framed(header: str, content: Column) -> Column:
        return F.concat(F.unhex(F.lit(header)), content)

    good = framed("0000000001", body)
    value = good
    if faults:
        value = (
            F.when(offset % 97 == 0, F.unhex(F.lit("0000")))
            .when(offset % 89 == 0, framed("0100000001", body))
            .when(offset % 83 == 0, framed("0000000007", body))
            .when(offset % 79 == 0, framed("0000000001", F.lit(b"not json")))
            .otherwise(good)
        )
    return rows.select(
        F.col("source_topic").alias("topic"),
        F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"),
        F.timestamp_millis(F.col("processing_time")).alias("timestamp"),
        F.col("account_id").cast("binary").alias("key"),
        value.alias("value"),
    )

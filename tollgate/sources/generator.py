"""Synthetic raw payloads from any id column, all by column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions import pan

# Networks set aside for documentation; callers are their hosts.
NETWORKS = ["192.0.2", "198.51.100", "203.0.113"]
HOSTS = 254
SHOPS = 40
CHANNEL_POOL = ["WEB", "MOBILE", "POS", "API"]
CURRENCY_POOL = ["USD", "EUR", "GBP", "BRL", "MXN"]
SCOPES = ["read", "write", "read write"]
ACCOUNTS = 10
API_KEYS = 5
LOW, HIGH = 1, 5000

_PRIME = 2_147_483_647


def draw(id_: Column, seed: int, size: int) -> Column:
    """A number in [0, size) that looks random over ids, the same for the same id and seed."""
    mixed = F.pmod(id_ % _PRIME * 48_271 + seed * 69_621, F.lit(_PRIME))
    return F.pmod(F.pmod(mixed * 16_807, F.lit(_PRIME)), F.lit(size))


def _pick(pool: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(value) for value in pool]), index.cast("int"))


def make_payloads(
    ids: DataFrame, event_time: Column, id_column: str = "id", keep: Sequence[str] = ()
) -> DataFrame:
    """One valid raw payload per id, after the columns to ``keep``."""
    id_ = F.col(id_column)
    cents = draw(id_, 4, (HIGH - LOW) * 100 + 1) + LOW * 100
    digits = F.concat(
        _pick(["4", "5"], draw(id_, 8, 2)),
        F.lpad(draw(id_, 9, 10_000_000).cast("string"), 7, "0"),
        F.lpad(draw(id_, 10, 10_000_000).cast("string"), 7, "0"),
    )
    digest = F.md5(F.concat(F.lit("txn/"), id_.cast("string")).cast("binary"))
    uuid4 = F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("4"), F.substring(digest, 14, 3)),
        F.concat(F.lit("a"), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
    return ids.select(
        *keep,
        uuid4.alias("transaction_id"),
        F.format_string("acc-%04d", draw(id_, 2, ACCOUNTS) + 1).alias("account_id"),
        F.format_string("shop-%03d", draw(id_, 3, SHOPS) + 1).alias("merchant_id"),
        (cents / 100).cast("decimal(18,2)").cast("string").alias("amount"),
        _pick(CURRENCY_POOL, draw(id_, 5, len(CURRENCY_POOL))).alias("currency"),
        event_time.cast("bigint").alias("event_time"),
        _pick(CHANNEL_POOL, draw(id_, 6, len(CHANNEL_POOL))).alias("channel"),
        pan.with_check_digit(digits, 15).alias("card_number"),
        F.concat_ws(
            ".", _pick(NETWORKS, draw(id_, 7, len(NETWORKS))), (draw(id_, 13, HOSTS) + 1).cast("string")
        ).alias("caller_ip"),
        F.concat(F.lit("key-"), (draw(id_, 11, API_KEYS) + 1).cast("string")).alias("api_key_id"),
        _pick(SCOPES, draw(id_, 12, len(SCOPES))).alias("oauth_scope"),
        F.lit(None).cast("float").alias("geo_lat"),
        F.lit(None).cast("float").alias("geo_lon"),
    )


def generate(spark: SparkSession, rows: int, start_ms: int, per_second: int = 5_000) -> DataFrame:
    """``rows`` payloads from ``start_ms`` on, at a steady rate."""
    ids = spark.range(rows)
    return make_payloads(ids, F.lit(start_ms) + F.expr(f"id * 1000 div {per_second}"))

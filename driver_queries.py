"""Registered queries over the driver's tables, each next to its DuckDB twin."""

from __future__ import annotations

from dataclasses import replace

import driver_sql as sql
import driver_tables as tables
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate import schemas
from tollgate.config import ProcessorConfig
from tollgate.functions import ip, pan
from tollgate.operators import dedup as dd
from tollgate.operators import device as dev
from tollgate.operators import dlq, frame, ingest, lateness, metrics, quality
from tollgate.operators import enrich as enr
from tollgate.operators import geo as geo_op
from tollgate.operators import velocity as vel
from tollgate.plans.enrichment import enrich
from tollgate.plans.processing import Processed, process
from tollgate.session import fresh_path, state_settings, write_durable
from tollgate.sources import event_log, generator
from tollgate.streaming.commits import Commits
from tollgate.streaming.dedup import ACCEPTED, start_dedup
from tollgate.streaming.enrich import read_valid, start_enrich
from tollgate.streaming.progress import ProgressLog
from tollgate.streaming.route import start_route

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
CFG = ProcessorConfig()
MINUTE = sql.MINUTE


def shown(df: DataFrame) -> DataFrame:
    """Decimals and floats as double, which both engines' clients return alike."""
    casts = {
        f.name: F.col(f.name).cast("double")
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DecimalType, T.FloatType))
    }
    return df.withColumns(casts) if casts else df


def register(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = lambda spark, sf_dir: shown(function(spark, sf_dir))
        if oracle is not None:
            ORACLE[name] = oracle
        return function

    return add


def base_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched records for the queries about enriched records: near repeats only."""
    rows = tables.transactions(spark, sf_dir, repeats=tables.NEAR_REPEATS)
    return enrich(rows, tables.blocks(spark), CFG, tables.enrichment_clock())


NEAR = sql.txn(repeats=tables.NEAR_REPEATS)
NEAR_FIRST = """uniq AS (
  SELECT * EXCLUDE rank FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY event_time, source_partition, source_offset) AS rank FROM txn) WHERE rank = 1
)"""
BASE_ENRICHED = [NEAR, NEAR_FIRST, sql.enriched()]
ENRICHED_OUT = f"""transaction_id, account_id, merchant_id, CAST(amount AS DOUBLE) AS amount, currency,
  event_time, processing_time, channel, card_bin, card_last4, caller_ip_subnet, api_key_id,
  oauth_scope, CAST(NULL AS DOUBLE) AS geo_lat, CAST(NULL AS DOUBLE) AS geo_lon, masking_lib_version,
  {sql.VEL_OUT}, geo_country, geo_city, geo_network_class,
  CAST(geo_confidence AS DOUBLE) AS geo_confidence, device_first_seen, device_txn_count,
  device_known_fraud, enrichment_time, enrichment_latency_ms,
  '{CFG.processor_version}' AS processor_version, '1' AS schema_version"""


# Enrichment


@register("enrich", sql.with_(sql.txn(), sql.dedup("txn"), sql.enriched()) + f"SELECT {ENRICHED_OUT} FROM enr")
def _enrich(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir)
    return enrich(rows, tables.blocks(spark), CFG, tables.enrichment_clock())


@register("dedup", sql.with_(sql.txn(), sql.dedup("txn")) + "SELECT transaction_id, event_time, source_partition, source_offset FROM uniq")
def _dedup(spark, sf_dir):
    return dd.dedup(tables.transactions(spark, sf_dir)).select(
        "transaction_id", "event_time", *schemas.ARRIVAL
    )


@register("first_per_id", sql.with_(NEAR, NEAR_FIRST) + "SELECT transaction_id, event_time, source_partition, source_offset FROM uniq")
def _first(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir, repeats=tables.NEAR_REPEATS)
    return dd.dedup(rows).select("transaction_id", "event_time", *schemas.ARRIVAL)


def _velocity_columns(df: DataFrame) -> DataFrame:
    return df.select("transaction_id", "source_offset", *schemas.VELOCITY.fieldNames())


VEL_SELECT = f"SELECT transaction_id, source_offset, {sql.VEL_OUT} FROM vel"


@register("velocity_bucket", sql.with_(sql.txn(), sql.bucket_velocity("txn")) + VEL_SELECT)
def _velocity(spark, sf_dir):
    return _velocity_columns(vel.velocity(tables.transactions(spark, sf_dir)))


@register("velocity_bucket_dense", sql.with_(sql.txn(60), sql.bucket_velocity("txn")) + VEL_SELECT)
def _velocity_dense(spark, sf_dir):
    return _velocity_columns(vel.velocity(tables.transactions(spark, sf_dir, 60)))


@register("velocity_exact", sql.with_(sql.txn(60), sql.exact_velocity("txn")) + VEL_SELECT)
def _velocity_exact(spark, sf_dir):
    return _velocity_columns(vel.velocity(tables.transactions(spark, sf_dir, 60), mode="exact"))


@register(
    "velocity_by_currency",
    sql.with_(sql.txn(60), sql.bucket_velocity("txn", keys="account_id, currency")) + VEL_SELECT,
)
def _velocity_currency(spark, sf_dir):
    return _velocity_columns(vel.velocity_by_currency(tables.transactions(spark, sf_dir, 60)))


@register(
    "minute_partials",
    sql.with_(sql.txn())
    + f"SELECT account_id, event_time // {MINUTE} AS bucket, count(*) AS cnt, "
    "CAST(sum(amount) AS DOUBLE) AS amount_sum FROM txn GROUP BY 1, 2",
)
def _minute_partials(spark, sf_dir):
    return vel.minute_partials(tables.transactions(spark, sf_dir))


@register(
    "device_profile",
    sql.with_(sql.txn(), sql.device("txn"))
    + "SELECT transaction_id, source_offset, device_first_seen, device_txn_count, device_known_fraud "
    "FROM txn LEFT JOIN dev USING (transaction_id, source_offset)",
)
def _device(spark, sf_dir):
    return dev.device_profile(tables.transactions(spark, sf_dir)).select(
        "transaction_id", "source_offset", *schemas.DEVICE.fieldNames()
    )


@register(
    "device_snapshot",
    sql.with_(sql.txn())
    + "SELECT api_key_id, min(event_time) AS device_first_seen, count(*) AS device_txn_count, "
    "max(event_time) AS device_last_seen FROM txn WHERE coalesce(api_key_id, '') <> '' GROUP BY 1",
)
def _device_snapshot(spark, sf_dir):
    return dev.device_snapshot(tables.transactions(spark, sf_dir))


@register(
    "device_key",
    sql.with_(sql.txn())
    + "SELECT coalesce(nullif(api_key_id, ''), '__no_device__') AS device, count(*) AS events FROM txn GROUP BY 1",
)
def _device_key(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir)
    return rows.groupBy(dev.device_key(F.col("api_key_id")).alias("device")).agg(
        F.count(F.lit(1)).alias("events")
    )


GEO_OUT = "geo_country, geo_city, geo_network_class, CAST(geo_confidence AS DOUBLE) AS geo_confidence"


@register(
    "geolocate",
    sql.with_(sql.txn(), sql.geo())
    + f"SELECT transaction_id, source_offset, {GEO_OUT} FROM txn LEFT JOIN geo USING (caller_ip_subnet)",
)
def _geolocate(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir)
    return geo_op.geolocate(rows, tables.blocks(spark)).select(
        "transaction_id", "source_offset", *schemas.GEO.fieldNames()
    )


@register(
    "geolocate_precision",
    sql.with_(sql.txn(), sql.geo())
    + "SELECT caller_ip_subnet, geo_country, geo_city, CAST(CASE WHEN geo_city IS NOT NULL THEN 1.0 "
    "WHEN geo_country IS NOT NULL THEN 0.5 END AS DOUBLE) AS geo_confidence, count(*) AS events "
    "FROM txn LEFT JOIN geo USING (caller_ip_subnet) GROUP BY ALL",
)
def _geolocate_precision(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir)
    located = geo_op.geolocate(rows, tables.blocks(spark), confidence="precision")
    keys = ["caller_ip_subnet", "geo_country", "geo_city", "geo_confidence"]
    return located.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"))


@register(
    "representative_host",
    sql.with_(sql.txn())
    + r"SELECT caller_ip_subnet, regexp_replace(caller_ip_subnet, '^(\d+\.\d+\.\d+)\.0$', '\1.1') AS host, "
    "count(*) AS events FROM txn GROUP BY 1, 2",
)
def _host(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir)
    suffixed = F.concat("caller_ip_subnet", F.lit("/24"))
    return rows.groupBy("caller_ip_subnet", ip.representative_host(suffixed).alias("host")).agg(
        F.count(F.lit(1)).alias("events")
    )


# Ingestion

PAYLOAD = f"""pay AS (
  SELECT CASE WHEN event_id % 41 <> 0 THEN 'txn-' || event_id END AS transaction_id,
    CASE WHEN event_id % 43 <> 0 THEN 'acc-' || user_id ELSE '' END AS account_id,
    CASE WHEN event_id % 47 = 0 THEN '4000123412341234' ELSE 'merch-' || (event_id % 8) END AS merchant_id,
    CASE WHEN event_id % 31 = 0 THEN 'ten'
      WHEN event_id % 37 = 0 THEN '-' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
      ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
    CASE WHEN event_id % 29 = 0 THEN 'US' ELSE ({sql._list(tables.CURRENCIES)})[event_id % 5 + 1] END AS currency,
    CASE WHEN event_id % 23 = 0 THEN (epoch_us(ts) // 1000) - 300001 ELSE epoch_us(ts) // 1000 END AS event_time,
    {sql._channel()} AS channel,
    ({sql._list(tables.CARDS)})[(event_id + user_id) % {len(tables.CARDS)} + 1] AS card_number,
    ({sql._list(tables.ADDRESSES)})[(event_id * 7 + user_id) % {len(tables.ADDRESSES)} + 1] AS caller_ip,
    ({sql._list(tables.SUBNETS)})[(event_id * 7 + user_id) % {len(tables.ADDRESSES)} + 1] AS subnet,
    CASE WHEN event_id % 53 <> 0 THEN 'key-' || (event_id % 5) END AS api_key_id,
    'transactions:write' AS oauth_scope, epoch_us(ts) // 1000 AS received_at, event_id
  FROM events
)"""
_MISSING = ", ".join(
    f"CASE WHEN coalesce({name}, '') = '' THEN '{name}' END"
    for name in ("transaction_id", "account_id", "merchant_id", "amount", "currency")
) + ", CASE WHEN coalesce(event_time, 0) = 0 THEN 'event_time' END, " + ", ".join(
    f"CASE WHEN coalesce({name}, '') = '' THEN '{name}' END"
    for name in ("channel", "card_number", "caller_ip", "api_key_id", "oauth_scope")
)
_CHANNEL_ERROR = "channel must be one of [''API'', ''MOBILE'', ''POS'', ''WEB'']"
CHECKED = f"""chk AS (
  SELECT *, list_filter([{_MISSING}], lambda x: x IS NOT NULL) AS missing, list_filter([
    CASE WHEN try_cast(amount AS DECIMAL(18,4)) IS NULL THEN 'amount must be a numeric value'
      WHEN try_cast(amount AS DECIMAL(18,4)) <= 0 THEN 'amount must be > 0' END,
    CASE WHEN length(currency) <> 3 THEN 'currency must be a 3-character ISO-4217 code' END,
    CASE WHEN channel NOT IN ('POS', 'WEB', 'MOBILE', 'API') THEN '{_CHANNEL_ERROR}' END,
    CASE WHEN coalesce(api_key_id, '') = '' THEN 'api_key_id must not be empty' END,
    CASE WHEN coalesce(oauth_scope, '') = '' THEN 'oauth_scope must not be empty' END,
    CASE WHEN abs(received_at - event_time) > 300000
      THEN 'event_time is more than 5 minutes from server time' END
  ], lambda x: x IS NOT NULL) AS errors, regexp_replace(card_number, '[\\s-]', '', 'g') AS digits
  FROM pay
), luhn AS (
  SELECT card_number, sum(CASE WHEN i % 2 = 1 THEN CASE WHEN d * 2 > 9 THEN d * 2 - 9 ELSE d * 2 END ELSE d END)
    % 10 = 0 AS luhn_ok
  FROM (SELECT card_number, i, CAST(substring(reverse(digits), i + 1, 1) AS INTEGER) AS d
    FROM (SELECT DISTINCT card_number, digits FROM chk WHERE regexp_full_match(digits, '[0-9]+')),
      range(0, 16) r(i) WHERE i < length(digits)) GROUP BY 1
), faults AS (
  SELECT *, CASE WHEN NOT regexp_full_match(digits, '[0-9]+') THEN 'PAN contains non-digit characters'
      WHEN length(digits) NOT IN (15, 16)
        THEN 'PAN length ' || length(digits) || ' is invalid (expected 15 or 16 digits)'
      WHEN NOT luhn_ok THEN 'Luhn check failed' END AS pan_error,
    CASE caller_ip WHEN '224.0.0.5' THEN 'multicast addresses must not be stored'
      WHEN '300.1.1.1' THEN 'not an IPv4 or IPv6 address' END AS ip_error
  FROM chk LEFT JOIN luhn USING (card_number)
), routed AS (
  SELECT *, CASE WHEN len(missing) > 0 OR len(errors) > 0 THEN 'ValidationError'
      WHEN pan_error IS NOT NULL THEN 'InvalidPANError'
      WHEN ip_error IS NOT NULL OR event_id % 47 = 0 THEN 'MaskingError' END AS error_type,
    CASE WHEN len(missing) > 0
        THEN 'Missing required fields: [''' || array_to_string(missing, ''', ''') || ''']'
      WHEN len(errors) > 0
        THEN 'Field validation errors: [''' || array_to_string(errors, ''', ''') || ''']'
      WHEN pan_error IS NOT NULL THEN pan_error
      WHEN ip_error IS NOT NULL THEN 'IP masking failed: ' || ip_error
      WHEN event_id % 47 = 0
        THEN 'PII LEAK: field ''merchant_id'' contains a full card-number-length digit sequence'
      END AS error_message,
    len(missing) = 0 AND len(errors) = 0 AND pan_error IS NULL AND ip_error IS NULL AS masking_applied
  FROM faults
)"""
INGEST = sql.with_(PAYLOAD, CHECKED)


def _masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.mask_payloads(tables.payloads(spark, sf_dir), now_ms=F.col("received_at"))


@register(
    "required_fields",
    INGEST + "SELECT array_to_string(missing, ',') AS missing, count(*) AS payloads FROM chk GROUP BY 1",
)
def _required(spark, sf_dir):
    rows = tables.payloads(spark, sf_dir)
    missing = F.array_join(ingest.missing_fields(rows.schema), ",")
    return rows.groupBy(missing.alias("missing")).agg(F.count(F.lit(1)).alias("payloads"))


@register(
    "field_values",
    INGEST + "SELECT array_to_string(errors, ';') AS errors, count(*) AS payloads FROM chk GROUP BY 1",
)
def _field_values(spark, sf_dir):
    rows = tables.payloads(spark, sf_dir)
    errors = F.array_join(ingest.field_errors(F.col("received_at")), ";")
    return rows.groupBy(errors.alias("errors")).agg(F.count(F.lit(1)).alias("payloads"))


@register(
    "card_masking",
    INGEST
    + "SELECT event_id, pan_error, CASE WHEN pan_error IS NULL THEN left(digits, 6) END AS card_bin, "
    "CASE WHEN pan_error IS NULL THEN right(digits, 4) END AS card_last4, CASE WHEN pan_error IS NULL "
    "THEN left(digits, 6) || repeat('*', length(digits) - 10) || right(digits, 4) END AS display FROM faults",
)
def _card_masking(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "events").select(
        "event_id",
        pan.normalise(
            tables.pick(tables.CARDS, (F.col("event_id") + F.col("user_id")) % len(tables.CARDS))
        ).alias("digits"),
    )
    digits, good = F.col("digits"), F.col("pan_error").isNull()
    return rows.withColumn("pan_error", pan.pan_error(digits)).select(
        "event_id",
        "pan_error",
        F.when(good, pan.card_bin(digits)).alias("card_bin"),
        F.when(good, pan.card_last4(digits)).alias("card_last4"),
        F.when(good, pan.masked_display(digits)).alias("display"),
    )


@register(
    "ip_truncation",
    INGEST + "SELECT event_id, subnet AS network, ip_error AS error FROM faults",
)
def _ip_truncation(spark, sf_dir):
    address = tables.pick(
        tables.ADDRESSES, (F.col("event_id") * 7 + F.col("user_id")) % len(tables.ADDRESSES)
    )
    return (
        tables.read(spark, sf_dir, "events")
        .select("event_id", ip.truncate(address).alias("_net"))
        .select("event_id", "_net.network", "_net.error")
    )


@register(
    "masked_events",
    INGEST
    + "SELECT transaction_id, account_id, merchant_id, CAST(CAST(amount AS DECIMAL(18,4)) AS DOUBLE) AS amount, "
    "currency, event_time, received_at AS processing_time, 'API' AS channel, left(digits, 6) AS card_bin, "
    "right(digits, 4) AS card_last4, subnet AS caller_ip_subnet, api_key_id, oauth_scope, "
    "CAST(NULL AS DOUBLE) AS geo_lat, CAST(NULL AS DOUBLE) AS geo_lon, '1.0.0' AS masking_lib_version, "
    "'1' AS schema_version FROM routed WHERE error_type IS NULL",
)
def _masked_events(spark, sf_dir):
    return ingest.accepted_events(_masked(spark, sf_dir))


@register(
    "ingest_rejects",
    INGEST
    + "SELECT coalesce(transaction_id, '') AS transaction_id, error_type, error_message, masking_applied, "
    "received_at AS failed_at, 'txn.api' AS source_topic FROM routed WHERE error_type IS NOT NULL",
)
def _ingest_rejects(spark, sf_dir):
    letters = ingest.rejects(_masked(spark, sf_dir), failed_at=F.col("received_at"))
    payload_id = F.get_json_object("original_payload", "$.transaction_id")
    return letters.select(
        F.coalesce(payload_id, F.lit("")).alias("transaction_id"),
        "error_type",
        "error_message",
        "masking_applied",
        "failed_at",
        "source_topic",
    )


@register(
    "leak_guard",
    INGEST
    + "SELECT CASE WHEN event_id % 47 = 0 THEN 'merchant_id' END AS leaked, count(*) AS payloads FROM pay GROUP BY 1",
)
def _leak_guard(spark, sf_dir):
    rows = tables.payloads(spark, sf_dir).drop("card_number")
    leaked = ingest.leaked_field(rows.schema)
    return rows.groupBy(leaked.alias("leaked")).agg(F.count(F.lit(1)).alias("payloads"))


# Frames, dead letters and replay

FRAMES = f"""fr AS (
  SELECT *, CASE WHEN source_offset % 97 = 0 THEN 'Payload too short: 2 bytes'
    WHEN source_offset % 89 = 0 THEN 'Invalid Confluent magic byte: 0x1'
    WHEN source_offset % 83 = 0 THEN 'Schema ID mismatch: got 7, expected 1'
    WHEN source_offset % 79 = 0 THEN 'Json deserialization failed: unreadable body'
    WHEN api_key_id IS NULL THEN 'Json deserialization failed: no value for api_key_id' END AS decode_error
  FROM txn
)"""


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tables.log_records(tables.transactions(spark, sf_dir))
    return frame.decode(log, "json", tables.LOG_SCHEMA_ID)


@register(
    "frame_decode",
    sql.with_(sql.txn(), FRAMES)
    + "SELECT source_topic, source_partition, source_offset, decode_error, "
    "CASE WHEN decode_error IS NULL THEN transaction_id END AS transaction_id, "
    "CASE WHEN decode_error IS NULL THEN CAST(amount AS DOUBLE) END AS amount, "
    "CASE WHEN decode_error IS NULL THEN event_time END AS event_time FROM fr",
)
def _frame_decode(spark, sf_dir):
    return _decoded(spark, sf_dir).select(
        *schemas.SOURCE.fieldNames(), "decode_error", "transaction_id", "amount", "event_time"
    )


@register(
    "frame_encode",
    sql.with_(sql.txn())
    + "SELECT 42 AS schema_id, '00' AS first_byte, transaction_id, account_id, currency FROM txn",
)
def _frame_encode(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir).select("transaction_id", "account_id", "currency")
    value = F.col("value")
    body = F.from_json(F.expr("substring(value, 6)").cast("string"), rows.schema)
    return (
        frame.encode(rows, 42, "json")
        .select(
            frame.schema_id(value).cast("int").alias("schema_id"),
            F.hex(F.substring(value, 1, 1)).alias("first_byte"),
            body.alias("_row"),
        )
        .select("schema_id", "first_byte", "_row.*")
    )


@register(
    "timestamp_to_epoch_ms",
    "SELECT event_id, epoch_us(ts) // 1000 AS ts FROM events",
)
def _to_epoch(spark, sf_dir):
    utc = F.timestamp_micros(
        tables.epoch_ms(F.col("ts")) * 1000
    )
    rows = tables.read(spark, sf_dir, "events").select("event_id", utc.alias("ts"))
    return frame.to_epoch_ms(rows, "ts")


LATE = f"""marks AS (
  SELECT *, max(event_time) OVER (PARTITION BY source_partition ORDER BY source_offset
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 10000 AS watermark FROM txn
), late AS (SELECT *, coalesce(event_time < watermark - 30000, false) AS is_late FROM marks)"""
PLAIN = sql.txn(repeats=[])


@register(
    "watermark_lateness",
    sql.with_(PLAIN, LATE) + "SELECT transaction_id, source_offset, watermark, is_late FROM late",
)
def _lateness(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir, repeats=[])
    return lateness.with_watermark_and_lateness(rows).select(
        "transaction_id", "source_offset", "watermark", "is_late"
    )


# Rows that do not decode have no event time: they move no watermark and are not late as well.
DECODED_ROWS = """sound AS (
  SELECT txn.* FROM txn ANTI JOIN (SELECT * FROM fr WHERE decode_error IS NOT NULL) bad
  USING (source_topic, source_partition, source_offset))"""
DECODED_LATE = LATE.replace("FROM txn", "FROM sound")
ALL_DEAD = sql.with_(PLAIN, FRAMES, DECODED_ROWS, DECODED_LATE) + """
SELECT source_topic, source_partition, source_offset, CAST(NULL AS VARCHAR) AS transaction_id,
  'SCHEMA_VALIDATION_ERROR' AS error_type, decode_error AS error_message,
  CAST(NULL AS BIGINT) AS watermark_at_rejection, CAST(NULL AS BIGINT) AS event_time_at_rejection
FROM fr WHERE decode_error IS NOT NULL
UNION ALL
SELECT source_topic, source_partition, source_offset, transaction_id, 'LATE_EVENT_BEYOND_ALLOWED_LATENESS',
  'event_time=' || event_time || ' is ' || (watermark - event_time) || 'ms behind watermark (allowed=30000ms)',
  watermark, event_time
FROM late WHERE is_late"""


def _dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.transactions(spark, sf_dir, repeats=[])
    decoded = frame.decode(tables.log_records(rows), "json", tables.LOG_SCHEMA_ID)
    flagged = lateness.with_watermark_and_lateness(frame.decoded_rows(decoded))
    return dlq.union_failures(
        dlq.schema_failures(decoded), dlq.late_events(flagged, CFG.lateness_ms)
    )


@register("dead_letters", ALL_DEAD)
def _dead(spark, sf_dir):
    return _dead_letters(spark, sf_dir).select(
        *schemas.SOURCE.fieldNames(),
        "transaction_id",
        "error_type",
        "error_message",
        "watermark_at_rejection",
        "event_time_at_rejection",
    )


@register(
    "replay_mismatched_schema",
    sql.with_(sql.txn(), FRAMES)
    + "SELECT source_partition, source_offset, CASE WHEN api_key_id IS NOT NULL THEN transaction_id END AS transaction_id, "
    "CASE WHEN api_key_id IS NOT NULL THEN account_id END AS account_id FROM fr "
    "WHERE decode_error LIKE 'Schema ID%'",
)
def _replay(spark, sf_dir):
    """Letters refused for their schema id, decoded again without that expectation.

    The letters are a table, as a stage writes them: the log is decoded once, for all that is read from them.
    """
    letters = write_durable(dlq.schema_failures(_decoded(spark, sf_dir)), "letters")
    wanted = letters.where(F.col("error_message").startswith("Schema ID")).select(
        *schemas.SOURCE.fieldNames()
    )
    again = dlq.replay(dlq.replay_selection(letters, wanted), "json")
    return again.select("source_partition", "source_offset", "transaction_id", "account_id")


# Quality

RECON = """sides AS (
  SELECT transaction_id, count(*) AS n_input, 0 AS n_enriched, 0 AS n_dlq FROM txn GROUP BY 1
  UNION ALL SELECT transaction_id, 0, count(*), 0 FROM txn WHERE source_offset % 7 <> 0 GROUP BY 1
  UNION ALL SELECT transaction_id, 0, 0, count(*) FROM txn WHERE source_offset % 11 = 0 GROUP BY 1
), tally AS (
  SELECT transaction_id, CAST(sum(n_input) AS BIGINT) AS n_input, CAST(sum(n_enriched) AS BIGINT) AS n_enriched,
    CAST(sum(n_dlq) AS BIGINT) AS n_dlq FROM sides GROUP BY 1
), recon AS (
  SELECT *, CASE WHEN n_input = 0 THEN 'unexpected' WHEN n_enriched + n_dlq = 0 THEN 'missing'
    WHEN n_enriched > 0 AND n_dlq > 0 THEN 'both' WHEN n_enriched + n_dlq > 1 THEN 'duplicate'
    ELSE 'ok' END AS status FROM tally
)"""


def _recon_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = tables.transactions(spark, sf_dir)
    return rows, rows.where("source_offset % 7 <> 0"), rows.where("source_offset % 11 = 0")


@register("reconcile", sql.with_(sql.txn(), RECON) + "SELECT * FROM recon")
def _reconcile(spark, sf_dir):
    return quality.reconcile(*_recon_sides(spark, sf_dir))


@register(
    "missing_outputs",
    sql.with_(sql.txn(), RECON) + "SELECT transaction_id FROM recon WHERE status = 'missing'",
)
def _missing_outputs(spark, sf_dir):
    return quality.missing_outputs(*_recon_sides(spark, sf_dir))


@register(
    "stage_correlation",
    sql.with_(*BASE_ENRICHED)
    + ", p AS (SELECT transaction_id, min(processing_time) AS published_at, count(*) AS arrivals FROM txn GROUP BY 1)"
    " SELECT transaction_id, published_at, arrivals, enrichment_time AS enriched_at, "
    "enrichment_time - published_at AS hop_ms FROM p JOIN enr USING (transaction_id)",
)
def _stage_correlation(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir, repeats=tables.NEAR_REPEATS)
    return quality.stage_correlation(rows, base_enriched(spark, sf_dir))


@register(
    "latest_per_id",
    sql.with_(sql.txn())
    + f"SELECT transaction_id, max({sql.CLOCK}) AS enrichment_time FROM txn GROUP BY 1",
)
def _latest(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir).withColumn("enrichment_time", tables.enrichment_clock())
    return dd.latest_per_id(rows).select("transaction_id", "enrichment_time")


_RULES = [f"('vel_count_{w} >= 1', vel_count_{w} < 1)" for w, _ in sql.WINDOWS]
_RULES += [f"('vel_amount_{w} > 0', vel_amount_{w} <= 0)" for w, _ in sql.WINDOWS]
_RULES += [
    f"('vel_count_{a} <= vel_count_{b}', vel_count_{a} > vel_count_{b})"
    for (a, _), (b, _) in zip(sql.WINDOWS, sql.WINDOWS[1:])
]
_RULES += ["('device_first_seen <= event_time', device_first_seen > event_time)"]
_RULES += ["('device_txn_count >= 1', device_txn_count < 1)"]
BROKEN = f"""broken AS (
  SELECT * REPLACE (CASE WHEN source_offset % 13 = 0 THEN 0 ELSE vel_count_5m END AS vel_count_5m,
    CASE WHEN source_offset % 17 = 0 THEN event_time + 1 ELSE device_first_seen END AS device_first_seen)
  FROM enr
)"""


@register(
    "feature_invariants",
    sql.with_(*BASE_ENRICHED, BROKEN)
    + f"SELECT transaction_id, unnest(list_transform(list_filter([{', '.join(f'row{r}' for r in _RULES)}], "
    "lambda r: r[2]), lambda r: r[1])) AS rule FROM broken",
)
def _invariants(spark, sf_dir):
    """Enriched records with some features damaged on purpose."""
    # The clock carries the offset: enrichment_time = processing_time + 10 + offset * 13 % 401.
    rows = tables.transactions(spark, sf_dir, repeats=tables.NEAR_REPEATS).select(
        "transaction_id", "source_offset"
    )
    offsets = rows.groupBy("transaction_id").agg(F.min("source_offset").alias("source_offset"))
    damaged = base_enriched(spark, sf_dir).join(offsets, "transaction_id").withColumns(
        {
            "vel_count_5m": F.when(F.col("source_offset") % 13 == 0, 0).otherwise(F.col("vel_count_5m")),
            "device_first_seen": F.when(
                F.col("source_offset") % 17 == 0, F.col("event_time") + 1
            ).otherwise(F.col("device_first_seen")),
        }
    )
    return quality.invariant_violations(damaged)


@register(
    "contract_violations",
    sql.with_(sql.txn(), sql.geo())
    + "SELECT 'required' AS rule, unnest(['api_key_id', 'merchant_id']) AS column_name, "
    "unnest([count(*) FILTER (api_key_id IS NULL), count(*) FILTER (source_offset % 19 = 0)]) AS violations FROM txn "
    "UNION ALL SELECT 'domain', 'geo_network_class', count(*) FROM txn WHERE source_offset % 23 = 0",
)
def _contract(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir)
    offset = F.col("source_offset")
    damaged = rows.withColumns(
        {
            "merchant_id": F.when(offset % 19 != 0, F.col("merchant_id")),
            "geo_network_class": F.when(offset % 23 == 0, "SATELLITE").otherwise("RESIDENTIAL"),
        }
    )
    contract = T.StructType([*schemas.DECODED.fields, schemas.ENRICHED["geo_network_class"]])
    found = quality.contract_violations(
        damaged, contract, {"geo_network_class": schemas.NETWORK_CLASSES}
    )
    return found.where(F.col("violations") > 0)


@register(
    "pii_audit",
    INGEST
    + "SELECT * FROM (SELECT unnest(['digit_run', 'digit_run', 'host_part']) AS rule, "
    "unnest(['merchant_id', 'card_number', 'caller_ip_subnet']) AS column_name, "
    "unnest([count(*) FILTER (regexp_matches(merchant_id, '[0-9]{15,19}')), "
    "count(*) FILTER (regexp_matches(card_number, '[0-9]{15,19}')), "
    "count(*) FILTER (caller_ip LIKE '%.%' AND caller_ip NOT LIKE '%.0')]) AS violations FROM pay) WHERE violations > 0",
)
def _pii_audit(spark, sf_dir):
    """An audit of raw payloads, which must find what masking removes."""
    rows = tables.payloads(spark, sf_dir).withColumnRenamed("caller_ip", "caller_ip_subnet")
    return quality.pii_audit(rows).where(F.col("violations") > 0)


LATE_IDS = "CAST(substring(transaction_id, 5) AS BIGINT) % 50 = 0"
FIX = (
    sql.with_(
        sql.txn(60, repeats=[]),
        f"ontime AS (SELECT * FROM txn WHERE NOT {LATE_IDS})",
        sql.bucket_velocity("ontime", "before"),
        sql.bucket_velocity("txn", "after"),
    )
    + "SELECT t.transaction_id, t.processing_time + 5000 AS enrichment_time, "
    + ", ".join(
        f"a.vel_count_{w} AS vel_count_{w}, CAST(a.vel_amount_{w} AS DOUBLE) AS vel_amount_{w}"
        for w, _ in sql.WINDOWS
    )
    + " FROM txn t JOIN before b USING (transaction_id) JOIN after a USING (transaction_id) WHERE "
    + " OR ".join(
        f"a.vel_count_{w} <> b.vel_count_{w} OR a.vel_amount_{w} <> b.vel_amount_{w}"
        for w, _ in sql.WINDOWS
    )
)


@register("corrections", FIX)
def _corrections(spark, sf_dir):
    """Records that change once the late rows are known."""
    rows = tables.transactions(spark, sf_dir, 60, repeats=[])
    is_late = F.substring("transaction_id", 5, 20).cast("bigint") % 50 == 0
    emitted = vel.velocity(rows.where(~is_late)).withColumn(
        "enrichment_time", F.col("processing_time") + 10
    )
    fixed = quality.corrections(
        rows, emitted, rows.where(is_late), F.col("processing_time") + 5000
    )
    return fixed.select("transaction_id", "enrichment_time", *schemas.VELOCITY.fieldNames())


LATE_DAYS = "(event_time // 86400000 % 7 = 3 AND CAST(substring(transaction_id, 5) AS BIGINT) % 5 = 0)"


@register(
    "corrections_by_day",
    FIX.replace(LATE_IDS, LATE_DAYS).replace(sql.txn(60, repeats=[]), sql.txn(2, repeats=[])),
)
def _corrections_by_day(spark, sf_dir):
    """Late rows on some days only: the other days of the stored records are not read."""
    day = quality.event_day(F.col("event_time"))
    rows = tables.transactions(spark, sf_dir, 2, repeats=[]).withColumn("event_day", day)
    few = (F.col("event_day") % 7 == 3) & (F.substring("transaction_id", 5, 20).cast("bigint") % 5 == 0)
    events = write_durable(rows.hint("rebalance", "event_day"), "events", "event_day")
    emitted = vel.velocity(rows.where(~few)).withColumn("enrichment_time", F.col("processing_time") + 10)
    emitted = write_durable(emitted.hint("rebalance", "event_day"), "emitted", "event_day")
    fixed = quality.corrections_by_day(
        events, emitted, events.where(few), F.col("processing_time") + 5000
    )
    return fixed.select("transaction_id", "enrichment_time", *schemas.VELOCITY.fieldNames())


# Metrics


@register(
    "dead_letter_counter",
    f"SELECT error_type, count(*) AS total FROM ({ALL_DEAD}) GROUP BY 1",
)
def _dlq_counter(spark, sf_dir):
    return metrics.counter(_dead_letters(spark, sf_dir), ["error_type"])


@register(
    "publish_counter",
    INGEST
    + "SELECT 'txn.api' AS topic, CASE WHEN error_type IS NULL THEN 'accepted' ELSE 'rejected' END AS status, "
    "error_type, count(*) AS total FROM routed GROUP BY 2, 3",
)
def _publish_counter(spark, sf_dir):
    status = F.when(F.col("error_type").isNull(), "accepted").otherwise("rejected")
    rows = _masked(spark, sf_dir).select(F.lit("txn.api").alias("topic"), status.alias("status"), "error_type")
    return metrics.counter(rows, ["topic", "status", "error_type"])


@register(
    "dedup_skipped",
    sql.with_(NEAR) + "SELECT count(*) - count(DISTINCT transaction_id) AS dedup_skipped_total FROM txn",
)
def _dedup_skipped(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir, repeats=tables.NEAR_REPEATS)
    return metrics.repeats_dropped(rows, dd.first_per_id(rows))


LAT = f"""lat AS (SELECT *, {sql.CLOCK} AS enrichment_time,
  {sql.CLOCK} - processing_time AS enrichment_latency_ms FROM txn)"""


def _latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.transactions(spark, sf_dir).withColumn("enrichment_time", tables.enrichment_clock())
    return rows.withColumn(
        "enrichment_latency_ms", enr.latency_ms(F.col("enrichment_time"), F.col("processing_time"))
    )


def _bounds(bounds) -> str:
    return "(VALUES " + ", ".join(f"(CAST({b} AS DOUBLE))" for b in bounds) + ", (CAST('inf' AS DOUBLE))) b(le)"


HIST = f"""hist AS (SELECT channel, le, count(*) FILTER (enrichment_latency_ms <= le) AS cumulative
  FROM lat, {_bounds(metrics.ENRICHMENT_BOUNDS)} GROUP BY 1, 2)"""


@register(
    "latency_histogram",
    sql.with_(sql.txn(), LAT, HIST)
    + "SELECT channel, CASE WHEN isinf(le) THEN '+Inf' ELSE CAST(CAST(le AS INTEGER) AS VARCHAR) END AS le, cumulative FROM hist",
)
def _histogram(spark, sf_dir):
    found = metrics.histogram(
        _latencies(spark, sf_dir), "enrichment_latency_ms", metrics.ENRICHMENT_BOUNDS, ["channel"]
    )
    le = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("int").cast("string"))
    return found.withColumn("le", le)


@register(
    "latency_quantiles",
    sql.with_(sql.txn(), LAT)
    + "SELECT unnest([0.5, 0.95, 0.99]::DOUBLE[]) AS quantile, "
    "round(unnest(quantile_cont(enrichment_latency_ms, [0.5, 0.95, 0.99])), 6) AS value FROM lat",
)
def _quantiles(spark, sf_dir):
    found = metrics.exact_quantiles(_latencies(spark, sf_dir), "enrichment_latency_ms")
    return found.withColumn("value", F.round("value", 6))


@register(
    "histogram_quantiles",
    sql.with_(sql.txn(), LAT, HIST)
    + """, spread AS (
  SELECT channel, le, cumulative, coalesce(lag(cumulative) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0) AS lower,
    max(cumulative) OVER (PARTITION BY channel) AS total
  FROM hist WINDOW w AS (PARTITION BY channel ORDER BY le)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY channel, q ORDER BY le) AS rank
  FROM spread, (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.95 AS DOUBLE)), (CAST(0.99 AS DOUBLE))) v(q) WHERE cumulative >= q * total
)
SELECT channel, q AS quantile, round(CASE WHEN isinf(le) THEN lower
  ELSE lower + (le - lower) * (q * total - below) / (cumulative - below) END, 6) AS value FROM ranked WHERE rank = 1""",
)
def _histogram_quantiles(spark, sf_dir):
    found = metrics.histogram(
        _latencies(spark, sf_dir), "enrichment_latency_ms", metrics.ENRICHMENT_BOUNDS, ["channel"]
    )
    return metrics.histogram_quantiles(found, ["channel"]).withColumn("value", F.round("value", 6))


def _rate_sql(source: str, time: str, minutes: int, label: str) -> str:
    return f"""SELECT {label}, (m + s) * {MINUTE} AS window_end, CAST(count(*) AS BIGINT) AS increase,
  round(count(*) / {minutes * 60.0}, 9) AS rate
FROM (SELECT {label}, {time} // {MINUTE} AS m FROM {source}), range(1, {minutes + 1}) r(s) GROUP BY 1, 2"""


@register("windowed_rate", sql.with_(sql.txn()) + _rate_sql("txn", "event_time", 5, "channel"))
def _rate(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir)
    return metrics.windowed_rate(rows, "event_time", ["channel"], 5).withColumn("rate", F.round("rate", 9))


@register(
    "dead_letter_alerts",
    sql.with_(PLAIN, LATE)
    + f"SELECT 'DLQEventsDetected' AS alert, 'critical' AS severity, (event_time // {MINUTE} + 1) * {MINUTE} AS window_end, "
    f"CAST(count(*) AS DOUBLE) AS value FROM late WHERE is_late GROUP BY 3",
)
def _dlq_alerts(spark, sf_dir):
    rows = lateness.with_watermark_and_lateness(tables.transactions(spark, sf_dir, repeats=[]))
    letters = dlq.late_events(rows, CFG.lateness_ms, failed_at=F.col("event_time"))
    return metrics.event_alerts(letters)


@register(
    "depth_alerts",
    sql.with_(PLAIN, LATE)
    + f"SELECT 'DLQDepthNonZero' AS alert, 'page' AS severity, (m + 1) * {MINUTE} AS window_end, "
    "CAST(sum(n) OVER (ORDER BY m) AS DOUBLE) AS value FROM "
    f"(SELECT event_time // {MINUTE} AS m, count(*) AS n FROM late WHERE is_late GROUP BY 1)",
)
def _depth_alerts(spark, sf_dir):
    rows = lateness.with_watermark_and_lateness(tables.transactions(spark, sf_dir, repeats=[]))
    return metrics.depth_alerts(dlq.late_events(rows, CFG.lateness_ms, failed_at=F.col("event_time")))


def _held_sql(values: str, alert: metrics.Alert) -> str:
    return f"""SELECT '{alert.name}' AS alert, '{alert.severity}' AS severity, window_end, CAST(value AS DOUBLE) AS value
FROM (SELECT *, count(*) OVER (ORDER BY window_end RANGE BETWEEN {alert.hold_minutes * MINUTE} PRECEDING
  AND CURRENT ROW) AS held FROM ({values}) WHERE value > {alert.limit}) WHERE held = {alert.hold_minutes + 1}"""


@register(
    "latency_alerts",
    sql.with_(
        sql.txn(60),
        LAT,
        f"spots AS (SELECT (enrichment_time // {MINUTE} + s) * {MINUTE} AS window_end, le, "
        "count(*) FILTER (enrichment_latency_ms <= le) AS cumulative FROM lat, range(1, 6) r(s), "
        f"{_bounds(metrics.ENRICHMENT_BOUNDS)} GROUP BY 1, 2)",
        """spread AS (SELECT window_end, le, cumulative, coalesce(lag(cumulative) OVER w, 0) AS below,
  coalesce(lag(le) OVER w, 0) AS lower, 0.99 * max(cumulative) OVER (PARTITION BY window_end) AS target
  FROM spots WINDOW w AS (PARTITION BY window_end ORDER BY le))""",
        """p99 AS (SELECT window_end, round(CASE WHEN isinf(le) THEN lower
    ELSE lower + (le - lower) * (target - below) / (cumulative - below) END, 6) AS value
  FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY le) AS rank FROM spread
    WHERE cumulative >= target) WHERE rank = 1)""",
    )
    + _held_sql("SELECT * FROM p99", metrics.ENRICHMENT_LATENCY),
)
def _latency_alerts(spark, sf_dir):
    rows = tables.transactions(spark, sf_dir, 60).withColumn("enrichment_time", tables.enrichment_clock())
    rows = rows.withColumn("enrichment_latency_ms", F.col("enrichment_time") - F.col("processing_time"))
    return metrics.latency_alerts(
        rows, "enrichment_latency_ms", "enrichment_time", metrics.ENRICHMENT_BOUNDS, metrics.ENRICHMENT_LATENCY
    ).withColumn("value", F.round("value", 6))


PUBLISHED = "pub AS (SELECT processing_time, processing_time - event_time + source_offset % 61 - 40 AS ms FROM txn)"


@register(
    "publish_latency_alerts",
    sql.with_(
        sql.txn(60),
        PUBLISHED,
        f"spots AS (SELECT (processing_time // {MINUTE} + s) * {MINUTE} AS window_end, le, "
        "count(*) FILTER (ms <= le) AS cumulative FROM pub, range(1, 6) r(s), "
        f"{_bounds(metrics.PUBLISH_BOUNDS)} GROUP BY 1, 2)",
        """spread AS (SELECT window_end, le, cumulative, coalesce(lag(cumulative) OVER w, 0) AS below,
  coalesce(lag(le) OVER w, 0) AS lower, 0.99 * max(cumulative) OVER (PARTITION BY window_end) AS target
  FROM spots WINDOW w AS (PARTITION BY window_end ORDER BY le))""",
        """p99 AS (SELECT window_end, round(CASE WHEN isinf(le) THEN lower
    ELSE lower + (le - lower) * (target - below) / (cumulative - below) END, 6) AS value
  FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY le) AS rank FROM spread
    WHERE cumulative >= target) WHERE rank = 1)""",
    )
    + _held_sql("SELECT * FROM p99", metrics.PUBLISH_LATENCY),
)
def _publish_latency_alerts(spark, sf_dir):
    """p99 of the time from event to log, shifted so that some windows stay below the limit."""
    rows = tables.transactions(spark, sf_dir, 60)
    taken = F.col("processing_time") - F.col("event_time") + F.col("source_offset") % 61 - 40
    return metrics.latency_alerts(
        rows.withColumn("ms", taken), "ms", "processing_time", metrics.PUBLISH_BOUNDS, metrics.PUBLISH_LATENCY
    ).withColumn("value", F.round("value", 6))


@register(
    "checkpoint_failure_alerts",
    sql.with_(sql.txn(60))
    + _held_sql(
        f"SELECT (m + s) * {MINUTE} AS window_end, count(*) AS value FROM (SELECT event_time // {MINUTE} AS m "
        "FROM txn WHERE source_offset % 9 = 0), range(1, 6) r(s) GROUP BY 1",
        metrics.CHECKPOINT_FAILURES,
    ),
)
def _checkpoint_failure_alerts(spark, sf_dir):
    failures = tables.transactions(spark, sf_dir, 60).where(F.col("source_offset") % 9 == 0)
    return metrics.failure_alerts(failures, "event_time")


@register(
    "error_rate_alerts",
    sql.with_(sql.txn(60))
    + _held_sql(
        f"SELECT (m + s) * {MINUTE} AS window_end, round(count(*) / 300.0, 9) AS value "
        f"FROM (SELECT event_time // {MINUTE} AS m FROM txn WHERE channel = 'FAX'), range(1, 6) r(s) GROUP BY 1",
        metrics.ERROR_RATE,
    ),
)
def _error_rate_alerts(spark, sf_dir):
    errors = tables.transactions(spark, sf_dir, 60).where(F.col("channel") == "FAX")
    return metrics.error_rate_alerts(errors, "event_time").withColumn("value", F.round("value", 9))


@register(
    "stall_alerts",
    sql.with_(PLAIN)
    + "SELECT 'WatermarkStalled' AS alert, 'warning' AS severity, event_time AS window_end, gap / 1000.0 AS value "
    "FROM (SELECT event_time, event_time - lag(event_time) OVER (ORDER BY event_time) AS gap FROM txn) "
    f"WHERE gap > 60000",
)
def _stall_alerts(spark, sf_dir):
    return metrics.stall_alerts(tables.transactions(spark, sf_dir, repeats=[]), "event_time")


@register(
    "state_sizes",
    sql.with_(sql.txn(), "top AS (SELECT max(event_time) AS last FROM txn)")
    + f"SELECT 'velocity' AS store, count(*) AS entries, count(*) * 28 AS bytes FROM (SELECT DISTINCT account_id, "
    f"event_time // {MINUTE} FROM txn, top WHERE event_time > last - {sql.DAY}) UNION ALL "
    "SELECT 'device', count(DISTINCT api_key_id), count(DISTINCT api_key_id) * 64 FROM txn, top "
    f"WHERE event_time > last - {7 * sql.DAY} UNION ALL "
    "SELECT 'dedup', count(DISTINCT transaction_id), count(DISTINCT transaction_id) * 40 FROM txn, top "
    f"WHERE event_time > last - {2 * sql.DAY}",
)
def _state_sizes(spark, sf_dir):
    return metrics.state_sizes(tables.transactions(spark, sf_dir))


@register(
    "masking_version_mix",
    sql.with_(sql.txn()) + "SELECT masking_lib_version, count(*) AS events FROM txn GROUP BY 1",
)
def _version_mix(spark, sf_dir):
    return metrics.version_mix(tables.transactions(spark, sf_dir))


@register(
    "clock_skew",
    sql.with_(sql.txn())
    + "SELECT api_key_id, count(*) AS events, "
    + ", ".join(
        f"round(quantile_cont(processing_time - event_time, {q}), 6) AS skew_p{int(q * 100)}_ms"
        for q in metrics.QUANTILES
    )
    + " FROM txn GROUP BY 1",
)
def _clock_skew(spark, sf_dir):
    found = metrics.clock_skew(tables.transactions(spark, sf_dir))
    return found.withColumns(
        {c: F.round(c, 6) for c in found.columns if c.startswith("skew_")}
    )


def _in_bounds(counts: DataFrame, found: DataFrame, keys: list[str], answers: dict[str, float]) -> DataFrame:
    """Whether the ranks of each answer in its group come as near to the quantile as a sketch promises.

    ``counts`` has rows per group and value as ``n``; ``answers`` names the columns and their quantiles.
    """
    ranks = [F.sum("n").alias("_total")]
    for name in answers:
        ranks.append(F.sum(F.when(F.col("value") < F.col(name), F.col("n")).otherwise(0)).alias(f"_below_{name}"))
        ranks.append(F.sum(F.when(F.col("value") <= F.col(name), F.col("n")).otherwise(0)).alias(f"_upto_{name}"))
    columns = [c for c in found.columns if c not in keys]
    ranked = counts.join(found, keys).groupBy(*keys, *columns).agg(*ranks)
    # the promise holds with 99 % confidence for one answer; twice the error all but surely for all
    slack = F.greatest(F.lit(1.0), 2 * metrics.SKETCH_RANK_ERROR * F.col("_total"))

    def near(name: str, quantile: float) -> Column:
        goal = quantile * F.col("_total")
        return (F.col(f"_below_{name}") <= goal + slack) & (F.col(f"_upto_{name}") >= goal - slack)

    return ranked.withColumns({f"{name}_in_bounds": near(name, q) for name, q in answers.items()})


@register(
    "clock_skew_sketched",
    sql.with_(sql.txn())
    + "SELECT api_key_id, count(*) AS events, "
    + ", ".join(f"true AS p{int(q * 100)}_in_bounds" for q in metrics.QUANTILES)
    + " FROM txn GROUP BY 1",
)
def _clock_skew_sketched(spark, sf_dir):
    """Sketched quantiles against all values of their key: each within the stated rank error."""
    rows = tables.transactions(spark, sf_dir).withColumn("key", F.coalesce("api_key_id", F.lit("")))
    skew = F.col("processing_time") - F.col("event_time")
    counts = rows.groupBy("key", skew.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    names = {f"p{int(q * 100)}": q for q in metrics.QUANTILES}
    found = metrics.clock_skew_sketched(rows, "key").withColumnsRenamed({f"skew_{p}_ms": p for p in names})
    return _in_bounds(counts, found, ["key"], names).select(
        F.nullif("key", F.lit("")).alias("api_key_id"), "events", *[f"{p}_in_bounds" for p in names]
    )


@register(
    "sliding_quantiles",
    sql.with_(sql.txn(60), LAT)
    + f"""SELECT channel, (enrichment_time // {MINUTE} + s) * {MINUTE} AS window_end, count(*) AS n,
  min(enrichment_latency_ms) AS lowest, max(enrichment_latency_ms) AS highest, true AS p99_in_bounds
FROM lat, range(1, 6) r(s) GROUP BY 1, 2""",
)
def _sliding_quantiles(spark, sf_dir):
    """Sketches per minute merged into five-minute windows; ends are exact, p99 by its rank in the window."""
    rows = tables.transactions(spark, sf_dir, 60).withColumn("enrichment_time", tables.enrichment_clock())
    rows = rows.withColumn("latency", F.col("enrichment_time") - F.col("processing_time"))
    sketches = metrics.quantile_sketches(rows, "latency", "enrichment_time", ["channel"])
    found = metrics.sliding_quantiles(sketches, ["channel"], 5, [0.0, 0.99, 1.0])
    lowest, p99, highest = (F.get("values", F.lit(i)) for i in range(3))
    found = found.select(
        "channel", "window_end", F.col("n").alias("events"),
        lowest.alias("lowest"), p99.alias("p99"), highest.alias("highest"),
    )
    minute = F.expr(f"enrichment_time div {MINUTE}L")
    counts = rows.groupBy("channel", minute.alias("minute"), F.col("latency").alias("value"))
    counts = counts.agg(F.count(F.lit(1)).alias("n")).withColumn(
        "_end", F.explode(F.sequence(F.col("minute") + 1, F.col("minute") + 5))
    ).withColumn("window_end", F.col("_end") * MINUTE)
    return _in_bounds(counts, found, ["channel", "window_end"], {"p99": 0.99}).select(
        "channel", "window_end", F.col("events").alias("n"), "lowest", "highest", "p99_in_bounds"
    )



# Messages and generator


@register(
    "tail_view",
    sql.with_(*BASE_ENRICHED)
    + "SELECT transaction_id, account_id, vel_count_1m, CASE WHEN geo_country IS NULL THEN 'geo=null' ELSE "
    "geo_country || ' / ' || coalesce(geo_city, 'None') END AS geo, device_txn_count, enrichment_latency_ms, "
    "CAST(vel_amount_1m AS DOUBLE) AS vel_amount_1m FROM enr",
)
def _tail_view(spark, sf_dir):
    return event_log.tail_view(event_log.keyed_json(base_enriched(spark, sf_dir)))


@register(
    "dead_letter_messages",
    f"SELECT source_offset, error_type AS header, error_message FROM ({ALL_DEAD})",
)
def _dead_letter_messages(spark, sf_dir):
    messages = event_log.with_error_header(_dead_letters(spark, sf_dir))
    return messages.select(
        F.get_json_object("value", "$.source_offset").cast("bigint").alias("source_offset"),
        F.get("headers", F.lit(0))["value"].cast("string").alias("header"),
        F.get_json_object("value", "$.error_message").alias("error_message"),
    )


@register(
    "generated_payloads",
    """SELECT event_id, 0 AS faults, CAST(16 AS INTEGER) AS card_digits, epoch_us(ts) // 1000 AS event_time,
  'acc-' || lpad(CAST((((event_id % 2147483647 * 48271 + 2 * 69621) % 2147483647) * 16807 % 2147483647) % 10 + 1 AS VARCHAR), 4, '0') AS account_id
FROM events""",
)
def _generated(spark, sf_dir):
    """Generated payloads pass every check of the ingestion stage."""
    ids = tables.read(spark, sf_dir, "events").withColumn("_ms", tables.epoch_ms(F.col("ts")))
    made = generator.make_payloads(ids, F.col("_ms"), "event_id", ["event_id"])
    masked = ingest.mask_payloads(made, now_ms=F.col("event_time"))
    return masked.select(
        "event_id",
        F.when(F.col("error_type").isNull(), 0).otherwise(1).alias("faults"),
        F.length("card_number").alias("card_digits"),
        "event_time",
        "account_id",
    )


# Streams: each runs to the end of its input and returns what it stored

STREAM_CFG = ProcessorConfig(expected_schema_id=tables.LOG_SCHEMA_ID)
HALF = "half AS (SELECT (max(event_id) + 1) // 2 * 10 AS cut FROM events)"


def _half(spark: SparkSession, sf_dir: str) -> int:
    """The source offset that cuts the events in two."""
    last = tables.read(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return (last + 1) // 2 * 10


def _route(spark: SparkSession, sf_dir: str) -> str:
    rows = tables.transactions(spark, sf_dir, repeats=[])
    root = fresh_path(spark, "route")
    cut = _half(spark, sf_dir)
    for part in (F.col("source_offset") < cut, F.col("source_offset") >= cut):
        tables.log_records(rows.where(part)).write.mode("append").parquet(f"{root}/in")
        log = event_log.read_log_files(spark, f"{root}/in", STREAM_CFG)
        with state_settings(spark):
            start_route(log, f"{root}/out", f"{root}/checkpoint", STREAM_CFG, once=True).awaitTermination()
    return f"{root}/out"


ROUTED = f"""{HALF}, mark AS (
  SELECT min(high) - 10000 AS watermark FROM (SELECT source_partition, max(event_time) AS high
    FROM fr, half WHERE source_offset < cut AND decode_error IS NULL GROUP BY 1)
), split AS (
  SELECT fr.*, CASE WHEN source_offset >= cut THEN watermark END AS seen,
    decode_error IS NULL AND source_offset >= cut AND event_time < watermark - 30000 AS is_late
  FROM fr, half, mark
)"""

@register(
    "stream_route_valid",
    sql.with_(PLAIN, FRAMES, ROUTED)
    + "SELECT transaction_id, source_offset, CAST(amount AS DOUBLE) AS amount FROM split "
    "WHERE decode_error IS NULL AND NOT is_late",
)
def _route_valid(spark, sf_dir):
    return spark.read.parquet(f"{_route(spark, sf_dir)}/valid").select(
        "transaction_id", "source_offset", "amount"
    )


@register(
    "stream_route_dead_letters",
    sql.with_(PLAIN, FRAMES, ROUTED)
    + "SELECT source_offset, CASE WHEN is_late THEN 'LATE_EVENT_BEYOND_ALLOWED_LATENESS' ELSE "
    "'SCHEMA_VALIDATION_ERROR' END AS error_type, CASE WHEN is_late THEN 'event_time=' || event_time || ' is ' || "
    "(seen - event_time) || 'ms behind watermark (allowed=30000ms)' ELSE decode_error END AS error_message, "
    "CASE WHEN is_late THEN seen END AS watermark_at_rejection FROM split WHERE decode_error IS NOT NULL OR is_late",
)
def _route_dead(spark, sf_dir):
    return spark.read.parquet(f"{_route(spark, sf_dir)}/dlq").select(
        "source_offset", "error_type", "error_message", "watermark_at_rejection"
    )


STREAM_TXN = sql.txn(repeats=tables.NEAR_REPEATS, late=False)


@register(
    "stream_enrich",
    sql.with_(
        STREAM_TXN,
        NEAR_FIRST,
        sql.enriched().replace(sql.CLOCK, "processing_time + 25"),
    )
    + f"SELECT {ENRICHED_OUT} FROM enr",
)
def _stream_enrich(spark, sf_dir):
    """Dedup, velocity and device state over two runs; events arrive in order."""
    rows = tables.transactions(spark, sf_dir, repeats=tables.NEAR_REPEATS, late=False)
    root = fresh_path(spark, "enrich")
    cut = _half(spark, sf_dir)
    for part in (F.col("source_offset") < cut, F.col("source_offset") >= cut):
        rows.where(part).write.mode("append").parquet(f"{root}/in/valid")
        with state_settings(spark):
            start_enrich(
                read_valid(spark, f"{root}/in", STREAM_CFG),
                f"{root}/out",
                f"{root}/checkpoint",
                tables.blocks(spark),
                STREAM_CFG,
                F.col("processing_time") + 25,
                once=True,
            ).awaitTermination()
    return Commits(spark, f"{root}/out").read("enriched", schemas.ENRICHED)


LARGE = "CASE WHEN event_id % 11 = 0 THEN CAST(60000000000000 AS DECIMAL(18,4)) ELSE CAST(value AS DECIMAL(18,4)) END"
TOO_LARGE = " ".join(
    f"WHEN vel_amount_{label} > 99999999999999.9999 THEN 'vel_amount_{label} exceeds its contract type'"
    for label, _ in sql.WINDOWS
)


@register(
    "stream_replay_after_crash",
    sql.with_(
        STREAM_TXN.replace("CAST(value AS DECIMAL(18,4))", LARGE),
        NEAR_FIRST,
        sql.bucket_velocity("uniq").replace("AS DECIMAL(18,4)) AS vel", "AS DECIMAL(38,4)) AS vel"),
    )
    + f"SELECT transaction_id, source_offset, CASE {TOO_LARGE} END AS letter, CASE WHEN (CASE {TOO_LARGE} END) "
    "IS NULL THEN CAST(vel_amount_24h AS DOUBLE) END AS vel_amount_24h FROM vel",
)
def _stream_replay_after_crash(spark, sf_dir):
    """Records and overflow letters of a stream that dies twice in the commit of its second batch.

    First between the writes of records and letters, then between their publications. Every run after
    a crash replays that batch from the checkpoint; each row comes out once.
    """
    rows = tables.transactions(spark, sf_dir, repeats=tables.NEAR_REPEATS, late=False)
    large = F.substring_index("transaction_id", "-", -1).cast("long") % 11 == 0
    rows = rows.withColumn("amount", F.when(large, 60_000_000_000_000).otherwise(F.col("amount")).cast("decimal(18,4)"))
    root, cut = fresh_path(spark, "crash"), _half(spark, sf_dir)
    stages = [(F.col("source_offset") < cut, [None])]
    stages.append((F.col("source_offset") >= cut, ["staged enriched", "published enriched", None]))
    for part, crashes in stages:
        rows.where(part).write.mode("append").parquet(f"{root}/in/valid")
        for crash in crashes:
            with state_settings(spark):
                query = start_enrich(
                    read_valid(spark, f"{root}/in", STREAM_CFG),
                    f"{root}/out",
                    f"{root}/checkpoint",
                    tables.blocks(spark),
                    STREAM_CFG,
                    F.col("processing_time") + 25,
                    once=True,
                    reached=_dies_at(crash),
                )
                try:
                    query.awaitTermination()
                except StreamingQueryException as error:
                    if crash is None or crash not in str(error):
                        raise
    done = Commits(spark, f"{root}/out")
    records = done.read("enriched", schemas.ENRICHED)
    letters = done.read("dlq", schemas.PROC_DLQ)
    offsets = rows.select("transaction_id", "source_offset")
    name = F.get_json_object(F.col("original_payload_bytes").cast("string"), "$.transaction_id")
    letters = letters.select(
        name.alias("transaction_id"), "source_offset", F.col("error_message").alias("letter"),
        F.lit(None).cast("double").alias("vel_amount_24h"),
    )
    first = offsets.groupBy("transaction_id").agg(F.min("source_offset").alias("source_offset"))
    good = records.join(first, "transaction_id").select(
        "transaction_id", "source_offset", F.lit(None).cast("string").alias("letter"),
        F.col("vel_amount_24h").cast("double").alias("vel_amount_24h"),
    )
    return good.unionByName(letters)


# The whole second stage in batch

PROCESSED = (
    sql.txn(repeats=tables.NEAR_REPEATS).replace("CAST(value AS DECIMAL(18,4))", LARGE),
    FRAMES,
    DECODED_ROWS,
    DECODED_LATE,
    "good AS (SELECT * EXCLUDE (watermark, is_late) FROM late WHERE NOT is_late)",
    NEAR_FIRST.replace("FROM txn", "FROM good"),
    sql.enriched().replace("AS DECIMAL(18,4)) AS vel", "AS DECIMAL(38,4)) AS vel"),
    f"judged AS (SELECT *, CASE {TOO_LARGE} END AS letter FROM enr)",
    """letters AS (
  SELECT source_topic, source_partition, source_offset, CAST(NULL AS VARCHAR) AS transaction_id,
    'SCHEMA_VALIDATION_ERROR' AS error_type, decode_error AS error_message FROM fr WHERE decode_error IS NOT NULL
  UNION ALL
  SELECT source_topic, source_partition, source_offset, transaction_id, 'LATE_EVENT_BEYOND_ALLOWED_LATENESS',
    'event_time=' || event_time || ' is ' || (watermark - event_time) || 'ms behind watermark (allowed=30000ms)'
  FROM late WHERE is_late
  UNION ALL
  SELECT source_topic, source_partition, source_offset, transaction_id, 'ENRICHMENT_EXCEPTION', letter
  FROM judged WHERE letter IS NOT NULL
)""",
)


def _processed(spark: SparkSession, sf_dir: str) -> Processed:
    """The stage over framed log records with faults, late rows, repeats and amounts that overflow."""
    rows = tables.transactions(spark, sf_dir, repeats=tables.NEAR_REPEATS)
    large = F.substring_index("transaction_id", "-", -1).cast("long") % 11 == 0
    rows = rows.withColumn("amount", F.when(large, 60_000_000_000_000).otherwise(F.col("amount")).cast("decimal(18,4)"))
    log = tables.log_records(rows)
    return process(log, tables.blocks(spark), STREAM_CFG, tables.enrichment_clock(), "json")


@register("process_records", sql.with_(*PROCESSED) + f"SELECT {ENRICHED_OUT} FROM judged WHERE letter IS NULL")
def _process_records(spark, sf_dir):
    return _processed(spark, sf_dir).records


@register("process_dead_letters", sql.with_(*PROCESSED) + "SELECT * FROM letters")
def _process_dead_letters(spark, sf_dir):
    """All three kinds of failure in one table, at most one letter per source offset."""
    return _processed(spark, sf_dir).letters.select(
        *schemas.SOURCE.fieldNames(), "transaction_id", "error_type", "error_message"
    )


@register(
    "process_reconcile",
    sql.with_(
        *PROCESSED,
        """sides AS (
  SELECT transaction_id, 1 AS n_input, 0 AS n_enriched, 0 AS n_dlq FROM sound
  UNION ALL SELECT transaction_id, 0, 1, 0 FROM judged WHERE letter IS NULL
  UNION ALL SELECT transaction_id, 0, 0, 1 FROM letters WHERE transaction_id IS NOT NULL
)""",
        RECON[RECON.index("tally AS") :],
    )
    + "SELECT * FROM recon",
)
def _process_reconcile(spark, sf_dir):
    """Every readable id against the stage's own records and letters."""
    done = _processed(spark, sf_dir)
    return quality.reconcile(frame.decoded_rows(done.decoded), done.records, done.letters)


@register(
    "process_counters",
    sql.with_(*PROCESSED)
    + """SELECT 'read' AS counter, count(*) AS total FROM txn
UNION ALL SELECT kind, count(l.error_type) FROM (VALUES ('SCHEMA_VALIDATION_ERROR'),
  ('LATE_EVENT_BEYOND_ALLOWED_LATENESS'), ('ENRICHMENT_EXCEPTION')) k(kind)
  LEFT JOIN letters l ON l.error_type = kind GROUP BY 1
UNION ALL SELECT 'repeats_dropped', (SELECT count(*) FROM good) - (SELECT count(*) FROM uniq)
UNION ALL SELECT 'records', count(*) FROM judged WHERE letter IS NULL""",
)
def _process_counters(spark, sf_dir):
    return _processed(spark, sf_dir).counters


def _dies_at(step: str | None):
    def reached(name: str) -> None:
        if name == step:
            raise RuntimeError(f"stopped by the query at: {name}")

    return reached


#: Idle limit of the devices below: an event type of a user, some ten events in a month.
SHORT_IDLE = 2 * sql.DAY


def _device_batch_sql(number: int) -> str:
    """Rows of one batch: their session of the rows before, and the earlier session begun after them."""
    return f"""SELECT b.transaction_id, b.since AS device_first_seen,
  CAST(b.counted + coalesce(CASE WHEN a.event_time - b.event_time <= {SHORT_IDLE} THEN a.rest END, 0) AS INTEGER)
    AS device_txn_count
FROM (
  SELECT *, first_value(event_time) OVER w AS since, row_number() OVER w AS counted FROM (
    SELECT *, sum(back) OVER (PARTITION BY device ORDER BY event_time, batch, event_id) AS spell FROM (
      SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY device ORDER BY event_time, batch, event_id)
        > {SHORT_IDLE} THEN 1 ELSE 0 END AS back FROM seen WHERE batch <= {number}
  )) WINDOW w AS (PARTITION BY device, spell ORDER BY event_time, batch, event_id)
) b ASOF LEFT JOIN (
  SELECT device, event_time, sum(n) OVER (PARTITION BY device, spell ORDER BY event_time DESC) AS rest FROM (
    SELECT *, sum(back) OVER (PARTITION BY device ORDER BY event_time) AS spell FROM (
      SELECT device, event_time, count(*) AS n, CASE WHEN event_time - lag(event_time)
        OVER (PARTITION BY device ORDER BY event_time) > {SHORT_IDLE} THEN 1 ELSE 0 END AS back
      FROM seen WHERE batch < {number} GROUP BY 1, 2
  ))
) a ON a.device = b.device AND b.event_time < a.event_time
WHERE b.batch = {number}"""


@register(
    "stream_device_sessions",
    "WITH seen AS (SELECT 'txn-' || event_id AS transaction_id, event_id, event_id % 3 AS batch, "
    "epoch_us(ts) // 1000 AS event_time, user_id || ' ' || event_type AS device FROM events)\n"
    + "\nUNION ALL\n".join(f"SELECT * FROM ({_device_batch_sql(number)})" for number in range(3)),
)
def _stream_device_sessions(spark, sf_dir):
    """Device history over three runs, each with events between those of the runs before."""
    events = tables.read(spark, sf_dir, "events")
    named = events.select(
        F.concat(F.lit("txn-"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.concat_ws(" ", F.col("user_id").cast("string"), "event_type").alias("device"),
        (F.col("event_id") % 3).alias("batch"),
    )
    rows = tables.transactions(spark, sf_dir, repeats=[], late=False).join(named, "transaction_id")
    rows = rows.withColumn("api_key_id", F.col("device"))
    root = fresh_path(spark, "sessions")
    cfg = replace(STREAM_CFG, device_idle_ms=SHORT_IDLE)
    for number in range(3):
        part = rows.where(F.col("batch") == number).drop("device", "batch")
        part.write.mode("append").parquet(f"{root}/in/valid")
        with state_settings(spark):
            start_enrich(
                read_valid(spark, f"{root}/in", cfg),
                f"{root}/out",
                f"{root}/checkpoint",
                tables.blocks(spark),
                cfg,
                F.col("processing_time") + 25,
                once=True,
            ).awaitTermination()
    records = Commits(spark, f"{root}/out").read("enriched", schemas.ENRICHED)
    return records.select("transaction_id", "device_first_seen", "device_txn_count")


#: Arrivals of each event's id: hours by which copy number `copy` is moved; every id has its own pattern.
RETURNS = 9
MOVED = "(event_id * 7 + copy * copy * 29 + copy * 60) % 200"


@register(
    "stream_dedup_returns",
    f"""WITH RECURSIVE arrivals AS (
  SELECT event_id, copy + 1 AS arrival, epoch_us(ts) // 1000 + {MOVED} * {tables.HOUR_MS} AS event_time
  FROM (SELECT event_id, ts, unnest(range({RETURNS})) AS copy FROM events)
), chain AS (
  SELECT event_id, CAST(0 AS BIGINT) AS arrival, CAST([] AS BIGINT[]) AS kept FROM events
  UNION ALL
  SELECT a.event_id, a.arrival, CASE WHEN len(list_filter(c.kept, lambda k: abs(k - a.event_time) < {48 * tables.HOUR_MS})) > 0
    THEN c.kept ELSE list_append(c.kept, a.event_time) END
  FROM chain c JOIN arrivals a ON a.event_id = c.event_id AND a.arrival = c.arrival + 1
)
SELECT 'txn-' || event_id AS transaction_id, unnest(kept) AS event_time FROM chain WHERE arrival = {RETURNS}""",
)
def _stream_dedup_returns(spark, sf_dir):
    """Copies of every id that come back earlier and later than those before, over two runs."""
    copies = tables.read(spark, sf_dir, "events").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(RETURNS - 1))))
    rows = copies.select(
        F.concat(F.lit("txn-"), F.col("event_id").cast("string")).alias("transaction_id"),
        (tables.epoch_ms(F.col("ts")) + F.expr(MOVED) * tables.HOUR_MS).alias("event_time"),
        F.lit("txn.api").alias("source_topic"),
        F.lit(0).alias("source_partition"),
        (F.col("event_id") * RETURNS + F.col("copy")).alias("source_offset"),
        "copy",
    )
    # the watermark under which the second run's rows were routed: none of them is behind it
    lowest = rows.where(F.col("copy") >= 5).agg(F.min("event_time")).first()[0]
    root = fresh_path(spark, "returns")
    for part, watermark in ((F.col("copy") < 5, None), (F.col("copy") >= 5, lowest)):
        mark = F.lit(watermark).cast("bigint").alias("routed_watermark")
        rows.where(part).drop("copy").select("*", mark).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(
            "transaction_id string, event_time bigint, source_topic string, source_partition int, "
            "source_offset bigint, routed_watermark bigint"
        ).parquet(f"{root}/in")
        start_dedup(stream, f"{root}/out", f"{root}/checkpoint", STREAM_CFG, once=True).awaitTermination()
    return Commits(spark, f"{root}/out").read("kept", ACCEPTED)


@register(
    "stream_progress",
    "SELECT 'route' AS query, CAST(count(*) AS BIGINT) AS input_rows, false AS failed FROM events",
)
def _stream_progress(spark, sf_dir):
    """Progress reports of a routing run over all events, added up per query."""
    rows = tables.transactions(spark, sf_dir, repeats=[])
    root = fresh_path(spark, "progress")
    tables.log_records(rows).write.parquet(f"{root}/in")
    log = event_log.read_log_files(spark, f"{root}/in", STREAM_CFG)
    reports = _logged(spark, lambda: start_route(log, f"{root}/out", f"{root}/checkpoint", STREAM_CFG, once=True))
    return reports.groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.max("failed").alias("failed")
    )


def _logged(spark: SparkSession, start) -> DataFrame:
    """The progress table of one query, from its start to its end."""
    kept = ProgressLog()
    spark.streams.addListener(kept)
    try:
        query = start()
        query.awaitTermination()
        if not kept.wait(query):
            raise TimeoutError("the last progress report did not arrive")
    finally:
        spark.streams.removeListener(kept)
    return kept.frame(spark)


#: Micro-batches of the query below: more than Spark keeps reports of.
MANY = 104


@register(
    "stream_progress_history",
    f"""WITH marked AS (SELECT epoch_us(ts) // 1000 AS ms FROM events),
mark AS (SELECT max(ms) - 600000 AS watermark FROM marked)
SELECT 'hours' AS query, {MANY} AS batches, count(*) AS input_rows, max(watermark) AS watermark,
  count(DISTINCT ms // {tables.HOUR_MS}) FILTER ((ms // {tables.HOUR_MS} + 1) * {tables.HOUR_MS} > watermark) AS state_rows,
  false AS failed FROM marked, mark""",
)
def _stream_progress_history(spark, sf_dir):
    """Hourly counts over many micro-batches: rows, last watermark and last state size of all reports."""
    root = fresh_path(spark, "history")
    times = tables.read(spark, sf_dir, "events").select(F.timestamp_millis(tables.epoch_ms(F.col("ts"))).alias("at"))
    times.repartition(MANY).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    hours = stream.withWatermark("at", "10 minutes").groupBy(F.window("at", "1 hour")).count()

    def start():
        with state_settings(spark, 1):
            writer = hours.writeStream.queryName("hours").format("noop").outputMode("append")
            writer = writer.option("checkpointLocation", f"{root}/checkpoint")
            return writer.trigger(availableNow=True).start()

    return _logged(spark, start).groupBy("query").agg(
        F.count_if(F.col("input_rows") > 0).alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.max("watermark").alias("watermark"),
        F.max_by("state_rows", "batch_id").alias("state_rows"),
        F.max("failed").alias("failed"),
    )

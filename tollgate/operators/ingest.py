"""Raw payloads to masked events, with routed rejects. One narrow stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.config import IngestConfig
from tollgate.functions import ip, pan
from tollgate.schemas import CHANNELS, INGEST_DLQ, MONEY, REQUIRED_FIELDS, SENSITIVE_FIELDS, TXN

VALIDATION_ERROR = "ValidationError"
MASKING_ERROR = "MaskingError"
# Text that is nothing but a card-number-length run of digits.
_LEAK = r"^[0-9]{15,19}\z"
_UUID4 = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-4[0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}\z"


def _compact(items: list[Column]) -> Column:
    """Array of the non-null items, in order."""
    return F.array_except(F.array(*items), F.array(F.lit(None).cast("string")))


def _listed(items: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(items, "', '"), F.lit("']"))


def missing_fields(schema: T.StructType) -> Column:
    """Names of required fields that are absent, null, empty or, for numbers, zero."""
    found = []
    for name in REQUIRED_FIELDS:
        if name not in schema.fieldNames():
            found.append(F.lit(name))
            continue
        value = F.col(name)
        blank = value == (F.lit("") if isinstance(schema[name].dataType, T.StringType) else F.lit(0))
        found.append(F.when(value.isNull() | blank, F.lit(name)))
    return _compact(found)


def field_errors(now_ms: Column, cfg: IngestConfig | None = None) -> Column:
    """All value faults of a payload as array<string>. ``now_ms`` is the receiving clock."""
    cfg = cfg or IngestConfig()
    amount, event_time = F.col("amount"), F.col("event_time").try_cast("bigint")
    number = amount.try_cast("decimal(38,6)")
    checks = [
        F.when(number.isNull(), F.lit("amount must be a numeric value"))
        .when(number.try_cast(MONEY).isNull(), F.lit("amount is out of range"))
        .when(number.cast(MONEY) <= 0, F.lit("amount must be > 0")),
        F.when(
            F.coalesce(F.length("currency"), F.lit(0)) != 3,
            F.lit("currency must be a 3-character ISO-4217 code"),
        ),
        F.when(
            ~F.coalesce(F.col("channel").isin(*CHANNELS), F.lit(False)),
            F.lit(f"channel must be one of {sorted(CHANNELS)}"),
        ),
        *[
            F.when(F.coalesce(F.col(name), F.lit("")) == "", F.lit(f"{name} must not be empty"))
            for name in ("api_key_id", "oauth_scope")
        ],
        F.when(
            F.col("event_time").isNotNull() & event_time.isNull(),
            F.lit("event_time must be epoch milliseconds"),
        ).when(
            F.abs(now_ms - event_time) > cfg.max_skew_ms,
            F.lit(f"event_time is more than {cfg.max_skew_ms // 60_000} minutes from server time"),
        ),
    ]
    if cfg.require_uuid:
        checks.append(
            F.when(
                ~F.coalesce(F.col("transaction_id").rlike(_UUID4), F.lit(False)),
                F.lit("transaction_id must be a UUID v4"),
            )
        )
    return _compact(checks)


def leaked_field(schema: T.StructType, skip: tuple[str, ...] = ()) -> Column:
    """Name of the first string column that holds a full card-number-length digit run."""
    names = [
        f.name for f in schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]
    return F.coalesce(
        *[F.when(F.col(name).rlike(_LEAK), F.lit(name)) for name in names],
        F.lit(None).cast("string"),
    )


def assert_no_card_column(schema: T.StructType) -> None:
    if "card_number" in schema.fieldNames():
        raise ValueError("PII LEAK: 'card_number' column present in events")


def _fault(error_type: str, message: Column) -> Column:
    return F.struct(F.lit(error_type).alias("type"), message.alias("message"))


def mask_payloads(
    payloads: DataFrame,
    cfg: IngestConfig | None = None,
    now_ms: Column | None = None,
    generated_id: Column | None = None,
) -> DataFrame:
    """Payload columns plus ``event`` (struct of the 17 event columns), ``error_type``,
    ``error_message`` and ``masking_applied``. The first fault wins; a good row has none.

    ``now_ms`` and ``generated_id`` default to the clock and a random UUID.
    """
    cfg = cfg or IngestConfig()
    clock = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    new_id = F.uuid() if generated_id is None else generated_id
    have = set(payloads.columns)
    df = payloads
    for field in ("transaction_id", "geo_lat", "geo_lon", *REQUIRED_FIELDS):
        if field not in have:
            df = df.withColumn(field, F.lit(None).cast("string"))
    df = df.withColumns(
        {
            "_missing": missing_fields(payloads.schema),
            "_errors": field_errors(clock, cfg),
            "_digits": pan.normalise(F.col("card_number")),
            "_net": ip.truncate(
                F.col("caller_ip"), cfg.masking.ipv4_prefix, cfg.masking.ipv6_prefix
            ),
            "_now": clock,
        }
    ).withColumn("_pan_error", pan.pan_error(F.col("_digits")))

    digits = F.col("_digits")
    values = {
        "transaction_id": F.coalesce(F.nullif(F.col("transaction_id"), F.lit("")), new_id),
        "amount": F.col("amount").try_cast("decimal(38,6)").try_cast(MONEY),
        "event_time": F.col("event_time").try_cast("bigint"),
        "processing_time": F.col("_now"),
        "channel": F.col("channel") if cfg.keep_channel else F.lit(cfg.channel),
        "card_bin": pan.card_bin(digits),
        "card_last4": pan.card_last4(digits),
        "caller_ip_subnet": F.col("_net.network"),
        "masking_lib_version": F.lit(cfg.masking.lib_version),
        "schema_version": F.lit(cfg.schema_version),
    }
    event = F.struct(
        *[
            values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in TXN.fields
        ]
    )
    df = df.withColumn("event", event)
    leak = F.coalesce(
        *[
            F.when(F.col(f"event.{f.name}").rlike(_LEAK), F.lit(f.name))
            for f in TXN.fields
            if isinstance(f.dataType, T.StringType)
        ]
    )
    df = df.withColumn("_leak", leak)
    fault = (
        F.when(
            F.size("_missing") > 0,
            _fault(
                VALIDATION_ERROR,
                F.concat(F.lit("Missing required fields: "), _listed(F.col("_missing"))),
            ),
        )
        .when(
            F.size("_errors") > 0,
            _fault(
                VALIDATION_ERROR,
                F.concat(F.lit("Field validation errors: "), _listed(F.col("_errors"))),
            ),
        )
        .when(F.col("_pan_error").isNotNull(), _fault(pan.INVALID_PAN, F.col("_pan_error")))
        .when(
            F.col("_net.error").isNotNull(),
            _fault(MASKING_ERROR, F.concat(F.lit("IP masking failed: "), F.col("_net.error"))),
        )
        .when(
            F.col("_leak").isNotNull(),
            _fault(
                MASKING_ERROR,
                F.concat(
                    F.lit("PII LEAK: field '"),
                    F.col("_leak"),
                    F.lit("' contains a full card-number-length digit sequence"),
                ),
            ),
        )
    )
    return (
        df.withColumn("_fault", fault)
        .withColumns(
            {
                "error_type": F.col("_fault.type"),
                "error_message": F.col("_fault.message"),
                "masking_applied": F.col("_fault").isNull()
                | F.col("_fault.message").startswith("PII LEAK"),
            }
        )
        .select(*payloads.columns, "event", "error_type", "error_message", "masking_applied")
    )


def accepted_events(masked: DataFrame) -> DataFrame:
    """The 17-column events of good rows."""
    events = masked.where(F.col("error_type").isNull()).select("event.*")
    assert_no_card_column(events.schema)
    return events


def rejects(
    masked: DataFrame,
    cfg: IngestConfig | None = None,
    failed_at: Column | None = None,
    host: Column | None = None,
    dlq_id: Column | None = None,
    leave_out: tuple[str, ...] = (),
) -> DataFrame:
    """Dead-letter envelopes of bad rows; the payload loses its sensitive fields.

    A text field that holds a full card number, whatever its name, is null in the payload.
    ``leave_out`` names helper columns that are not part of the payload.
    """
    cfg = cfg or IngestConfig()
    technical = ("event", "error_type", "error_message", "masking_applied", *leave_out)
    names = [c for c in masked.columns if c not in technical and c not in SENSITIVE_FIELDS]
    texts = {f.name for f in masked.schema.fields if isinstance(f.dataType, T.StringType)}
    kept = [
        F.when(~F.col(c).rlike(_LEAK), F.col(c)).alias(c) if c in texts else F.col(c) for c in names
    ]
    payload = F.to_json(F.struct(*kept), {"ignoreNullFields": "false"})
    values = {
        "dlq_id": F.uuid() if dlq_id is None else dlq_id,
        "source_topic": F.lit(cfg.topic),
        "original_payload": payload,
        "error_type": F.col("error_type"),
        "error_message": F.col("error_message"),
        "failed_at": F.unix_millis(F.current_timestamp()) if failed_at is None else failed_at,
        "producer_host": F.lit(_host()) if host is None else host,
        "masking_applied": F.col("masking_applied"),
    }
    return masked.where(F.col("error_type").isNotNull()).select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in INGEST_DLQ.fields]
    )


def _host() -> str:
    import socket

    return socket.gethostname()

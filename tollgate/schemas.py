"""Data contracts as StructTypes, with value domains and the matching Avro schema text."""

from __future__ import annotations

import json

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)

# Fixed values of the contracts.
CHANNELS = ("API", "MOBILE", "POS", "WEB")
NETWORK_CLASSES = ("RESIDENTIAL", "BUSINESS", "HOSTING", "MOBILE", "UNKNOWN")
SCHEMA_ERROR = "SCHEMA_VALIDATION_ERROR"
LATE_ERROR = "LATE_EVENT_BEYOND_ALLOWED_LATENESS"
ENRICHMENT_ERROR = "ENRICHMENT_EXCEPTION"
DLQ_ERROR_TYPES = (SCHEMA_ERROR, LATE_ERROR, ENRICHMENT_ERROR)
VELOCITY_WINDOWS = (("1m", 1), ("5m", 5), ("1h", 60), ("24h", 1440))  # label, minutes
REQUIRED_FIELDS = (
    "transaction_id",
    "account_id",
    "merchant_id",
    "amount",
    "currency",
    "event_time",
    "channel",
    "card_number",
    "caller_ip",
    "api_key_id",
    "oauth_scope",
)
SENSITIVE_FIELDS = ("card_number", "caller_ip")
FORBIDDEN_FIELDS = ("card_number", "pan")


def _struct(*fields: tuple) -> T.StructType:
    """Fields are (name, type) when required and (name, type, None) when nullable."""
    return T.StructType([T.StructField(f[0], f[1], len(f) == 3) for f in fields])


_S, _L, _I, _F, _B = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.FloatType(),
    T.BooleanType(),
)

RAW_PAYLOAD = _struct(
    ("transaction_id", _S, None),
    ("account_id", _S, None),
    ("merchant_id", _S, None),
    ("amount", _S, None),
    ("currency", _S, None),
    ("event_time", _L, None),
    ("channel", _S, None),
    ("card_number", _S, None),
    ("caller_ip", _S, None),
    ("api_key_id", _S, None),
    ("oauth_scope", _S, None),
    ("geo_lat", _F, None),
    ("geo_lon", _F, None),
)

TXN = _struct(
    ("transaction_id", _S),
    ("account_id", _S),
    ("merchant_id", _S),
    ("amount", MONEY),
    ("currency", _S),
    ("event_time", _L),
    ("processing_time", _L),
    ("channel", _S),
    ("card_bin", _S),
    ("card_last4", _S),
    ("caller_ip_subnet", _S),
    ("api_key_id", _S),
    ("oauth_scope", _S),
    ("geo_lat", _F, None),
    ("geo_lon", _F, None),
    ("masking_lib_version", _S),
    ("schema_version", _S),
)

# What the stream carries after decoding: the event without its schema version.
DECODED = T.StructType([f for f in TXN.fields if f.name != "schema_version"])

VELOCITY = _struct(
    *[
        pair
        for label, _ in VELOCITY_WINDOWS
        for pair in ((f"vel_count_{label}", _I), (f"vel_amount_{label}", MONEY))
    ]
)
GEO = _struct(
    ("geo_country", _S, None),
    ("geo_city", _S, None),
    ("geo_network_class", _S, None),
    ("geo_confidence", _F, None),
)
DEVICE = _struct(
    ("device_first_seen", _L, None),
    ("device_txn_count", _I, None),
    ("device_known_fraud", _B, None),
)
STAMP = _struct(
    ("enrichment_time", _L),
    ("enrichment_latency_ms", _I),
    ("processor_version", _S),
    ("schema_version", _S),
)
ENRICHED = T.StructType(
    DECODED.fields + VELOCITY.fields + GEO.fields + DEVICE.fields + STAMP.fields
)

INGEST_DLQ = _struct(
    ("dlq_id", _S),
    ("source_topic", _S),
    ("original_payload", _S),
    ("error_type", _S),
    ("error_message", _S),
    ("failed_at", _L),
    ("producer_host", _S),
    ("masking_applied", _B),
)

PROC_DLQ = _struct(
    ("dlq_id", _S),
    ("source_topic", _S),
    ("source_partition", _I),
    ("source_offset", _L),
    ("transaction_id", _S, None),
    ("original_payload_bytes", T.BinaryType()),
    ("error_type", _S),
    ("error_message", _S),
    ("watermark_at_rejection", _L, None),
    ("event_time_at_rejection", _L, None),
    ("failed_at", _L),
    ("processor_host", _S),
    ("processor_subtask_index", _I),
)

# Columns a log record has around its framed value.
LOG = _struct(
    ("topic", _S),
    ("partition", _I),
    ("offset", _L),
    ("timestamp", T.TimestampType(), None),
    ("key", T.BinaryType(), None),
    ("value", T.BinaryType(), None),
)
# Where a decoded row came from; its order within the log.
SOURCE = _struct(("source_topic", _S), ("source_partition", _I), ("source_offset", _L))
ARRIVAL = ("source_partition", "source_offset")

ENUMS = {"geo_network_class": NETWORK_CLASSES, "error_type": DLQ_ERROR_TYPES}

_AVRO_NAMES = {
    T.StringType: "string",
    T.LongType: "long",
    T.IntegerType: "int",
    T.FloatType: "float",
    T.BooleanType: "boolean",
    T.BinaryType: "bytes",
}


def avro_schema(struct: T.StructType, name: str, enums: dict | None = None) -> str:
    """Avro record schema text of a contract.

    Epoch-ms longs stay plain longs: the bytes equal those of timestamp-millis, and decoding
    gives the epoch-ms number the contracts use.
    """
    enums = enums or {}

    def field_type(field: T.StructField):
        if field.name in enums:
            kind = {
                "type": "enum",
                "name": "".join(part.title() for part in field.name.split("_")),
                "symbols": list(enums[field.name]),
            }
        elif isinstance(field.dataType, T.DecimalType):
            kind = {
                "type": "bytes",
                "logicalType": "decimal",
                "precision": field.dataType.precision,
                "scale": field.dataType.scale,
            }
        else:
            kind = _AVRO_NAMES[type(field.dataType)]
        return ["null", kind] if field.nullable else kind

    fields = []
    for field in struct.fields:
        entry = {"name": field.name, "type": field_type(field)}
        if field.nullable:
            entry["default"] = None
        fields.append(entry)
    return json.dumps({"type": "record", "name": name, "fields": fields})

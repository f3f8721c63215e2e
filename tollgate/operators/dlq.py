"""Processing dead letters: one envelope for every kind of failure."""

from __future__ import annotations

import socket

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.operators.frame import decode
from tollgate.schemas import LATE_ERROR, PROC_DLQ, SCHEMA_ERROR


def stable_id(error_type: Column) -> Column:
    """Id from the source coordinates: the same failure gets the same id on every replay."""
    digest = F.sha2(
        F.concat_ws("/", "source_topic", "source_partition", "source_offset", error_type), 256
    )
    return F.concat_ws(
        "-",
        *[F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))],
    )


def envelope(
    rows: DataFrame,
    error_type: Column,
    error_message: Column,
    payload: Column,
    watermark: Column | None = None,
    event_time: Column | None = None,
    dlq_id: Column | None = None,
    failed_at: Column | None = None,
    host: Column | None = None,
    subtask: Column | None = None,
) -> DataFrame:
    """Rows with source coordinates (and maybe a transaction id) as 13-column envelopes."""
    nothing = F.lit(None)
    known_id = "transaction_id" in rows.columns
    values = {
        "dlq_id": F.uuid() if dlq_id is None else dlq_id,
        "source_topic": F.col("source_topic"),
        "source_partition": F.col("source_partition"),
        "source_offset": F.col("source_offset"),
        "transaction_id": F.col("transaction_id") if known_id else nothing,
        "original_payload_bytes": payload,
        "error_type": error_type,
        "error_message": error_message,
        "watermark_at_rejection": nothing if watermark is None else watermark,
        "event_time_at_rejection": nothing if event_time is None else event_time,
        "failed_at": F.unix_millis(F.current_timestamp()) if failed_at is None else failed_at,
        "processor_host": F.lit(socket.gethostname()) if host is None else host,
        "processor_subtask_index": F.spark_partition_id() if subtask is None else subtask,
    }
    return rows.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in PROC_DLQ.fields])


def schema_failures(decoded: DataFrame, **stamps: Column) -> DataFrame:
    """Envelopes of rows that did not decode, with their bytes."""
    return envelope(
        decoded.where(F.col("decode_error").isNotNull()),
        F.lit(SCHEMA_ERROR),
        F.col("decode_error"),
        F.coalesce("value", F.lit(b"")),
        **stamps,
    )


def late_message(allowed_ms: int) -> Column:
    return F.concat(
        F.lit("event_time="),
        F.col("event_time").cast("string"),
        F.lit(" is "),
        (F.col("watermark") - F.col("event_time")).cast("string"),
        F.lit(f"ms behind watermark (allowed={allowed_ms}ms)"),
    )


def late_events(flagged: DataFrame, allowed_ms: int, **stamps: Column) -> DataFrame:
    """Envelopes of rows flagged late; the payload is the record's own bytes where it is there."""
    late = flagged.where(F.col("is_late"))
    if "value" in flagged.columns:
        payload = F.col("value")
    else:
        technical = ("watermark", "is_late", "source_topic", "source_partition", "source_offset")
        payload = F.to_json(F.struct(*[c for c in flagged.columns if c not in technical])).cast("binary")
    return envelope(
        late,
        F.lit(LATE_ERROR),
        late_message(allowed_ms),
        payload,
        watermark=F.col("watermark"),
        event_time=F.col("event_time"),
        **stamps,
    )


def union_failures(*branches: DataFrame) -> DataFrame:
    """All failures as one table."""
    result = branches[0]
    for branch in branches[1:]:
        result = result.unionByName(branch)
    return result


def replay_selection(dlq: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Dead letters at the given (source_topic, source_partition, source_offset)."""
    return dlq.join(
        coordinates, ["source_topic", "source_partition", "source_offset"], "left_semi"
    )


def replay(dlq: DataFrame, body: str = "avro", expected_schema_id: int | None = None) -> DataFrame:
    """Decode the kept bytes of dead letters again."""
    log = dlq.select(
        F.col("source_topic").alias("topic"),
        F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"),
        F.col("original_payload_bytes").alias("value"),
    )
    return decode(log, body, expected_schema_id)

"""Framed messages: zero byte, four-byte schema id, body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions.let import bind
from tollgate.schemas import DECODED, avro_schema

HEADER_BYTES = 5


def schema_id(value: Column) -> Column:
    """Big-endian unsigned schema id of a framed value."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")


def frame_error(value: Column, expected_schema_id: int | None = None) -> Column:
    """Why the frame is bad, or null."""
    size = F.coalesce(F.octet_length(value), F.lit(0))
    first = F.hex(F.substring(value, 1, 1))
    error = F.when(
        size < HEADER_BYTES,
        F.concat(F.lit("Payload too short: "), size.cast("string"), F.lit(" bytes")),
    ).when(
        first != "00",
        F.concat(
            F.lit("Invalid Confluent magic byte: 0x"),
            F.lower(F.regexp_replace(first, "^0(?=.)", "")),
        ),
    )
    if expected_schema_id is not None:
        error = error.when(
            schema_id(value) != expected_schema_id,
            F.concat(
                F.lit("Schema ID mismatch: got "),
                schema_id(value).cast("string"),
                F.lit(f", expected {expected_schema_id}"),
            ),
        )
    return error


def _json_body(body: Column, schema: T.StructType) -> Column:
    open_schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return F.from_json(body.cast("string"), open_schema, {"mode": "PERMISSIVE"})


def _avro_body(body: Column, schema: T.StructType) -> Column:
    from pyspark.sql.avro.functions import from_avro

    return from_avro(body, avro_schema(schema, "Transaction"), {"mode": "PERMISSIVE"})


def decode(
    log: DataFrame,
    body: str = "avro",
    expected_schema_id: int | None = None,
    schema: T.StructType = DECODED,
) -> DataFrame:
    """Log records to rows: topic, partition, offset, value, ``decode_error`` and the body columns.

    A row with a bad frame, an unreadable body or a missing required field has an error and null
    body columns. ``body`` is "avro" (needs the spark-avro package) or "json".
    """
    reader = {"avro": _avro_body, "json": _json_body}[body]
    required = [f.name for f in schema.fields if not f.nullable]
    failed = f"{body.title()} deserialization failed: "

    def verdict(row: Column | None, error: Column) -> Column:
        body_type = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        kept = F.lit(None) if row is None else F.when(error.isNull(), row)
        return F.struct(kept.cast(body_type).alias("row"), error.alias("error"))

    def judge(row: Column) -> Column:
        """Name the required fields without a value."""
        gaps = [F.when(row[name].isNull(), F.lit(name)) for name in required]

        def error(absent: Column) -> Column:
            unreadable = row.isNull() | (absent == ", ".join(required))
            return F.when(unreadable, F.lit(f"{failed}unreadable body")).when(
                absent != "", F.concat(F.lit(f"{failed}no value for "), absent)
            )

        return bind(bind(F.concat_ws(", ", *gaps), error), lambda fault: verdict(row, fault))

    def read(value: Column) -> Column:
        rest = F.substring(value, HEADER_BYTES + 1, 2**31 - 1 - HEADER_BYTES)
        return bind(
            frame_error(value, expected_schema_id),
            lambda fault: F.when(fault.isNotNull(), verdict(None, fault)).otherwise(bind(reader(rest, schema), judge)),
        )

    return log.withColumn("_read", bind(F.col("value"), read)).select(
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        "value",
        F.col("_read.error").alias("decode_error"),
        *[F.col(f"_read.row.{f.name}").alias(f.name) for f in schema.fields],
    )


def decoded_rows(decoded: DataFrame) -> DataFrame:
    """Good rows, without frame and error."""
    return decoded.where(F.col("decode_error").isNull()).drop("value", "decode_error")


def _header(registered_id: int) -> Column:
    return F.unhex(F.lit(f"00{registered_id:08x}"))


def encode(
    df: DataFrame,
    registered_id: int,
    body: str = "avro",
    name: str = "Record",
    enums: dict | None = None,
) -> DataFrame:
    """Rows to one binary column ``value``: header and body. Avro needs the spark-avro package."""
    row = F.struct(*df.columns)
    if body == "avro":
        from pyspark.sql.avro.functions import to_avro

        payload = to_avro(row, avro_schema(df.schema, name, enums))
    elif body == "json":
        payload = F.to_json(row, {"ignoreNullFields": "false"}).cast("binary")
    else:
        raise ValueError(f"unknown body format: {body!r}")
    return df.select(F.concat(_header(registered_id), payload).alias("value"))


def to_epoch_ms(df: DataFrame, *names: str) -> DataFrame:
    """Timestamp columns as epoch milliseconds."""
    return df.withColumns({name: F.unix_millis(F.col(name)) for name in names})

"""Contracts, frames, dead letters, log messages."""

import json
import struct

import pytest
from support import SF, T0
from pyspark.sql import functions as F

import driver_queries
import driver_tables as tables
from tollgate import schemas
from tollgate.config import ProcessorConfig
from tollgate.operators import dlq, frame, quality
from tollgate.sources import event_log
from tollgate.sources.generator import ACCOUNTS, HOSTS, NETWORKS, SHOPS, generate
from tollgate.plans.ingestion import ingest

BODY = {
    "transaction_id": "txn-001", "account_id": "acc-123", "merchant_id": "m", "amount": 49.99, "currency": "USD",
    "event_time": T0, "processing_time": T0 + 10, "channel": "API", "card_bin": "411111", "card_last4": "1111",
    "caller_ip_subnet": "203.0.113.0", "api_key_id": "key-abc", "oauth_scope": "s", "masking_lib_version": "1.0.0",
}


def framed(body, schema_id=1, first=0):
    return bytes([first]) + struct.pack(">I", schema_id) + body


def decode(spark, value, **kwargs):
    df = spark.createDataFrame([("txn.api", 3, 7, None, None, value)], schemas.LOG)
    return frame.decode(df, "json", **kwargs)


@pytest.mark.parametrize(
    ("value", "error"),
    [
        (b"\x00\x00", "Payload too short: 2 bytes"),
        (b"", "Payload too short: 0 bytes"),
        (framed(b"x" * 20, first=1), "Invalid Confluent magic byte: 0x1"),
        (framed(b"x" * 20, first=0xFF), "Invalid Confluent magic byte: 0xff"),
        (framed(b"\xff" * 30), "Json deserialization failed: unreadable body"),
        (framed(b"\xff" * 10, 5), "Schema ID mismatch: got 5, expected 1"),
        (framed(json.dumps({**BODY, "account_id": None}).encode()), "Json deserialization failed: no value for account_id"),
    ],
)
def test_bad_frames(spark, value, error):
    decoded = decode(spark, value, expected_schema_id=1)
    row = decoded.first()
    assert row.decode_error == error and row.transaction_id is None
    letter = dlq.schema_failures(decoded).first()
    assert (letter.error_type, letter.error_message) == (schemas.SCHEMA_ERROR, error)
    assert (letter.source_topic, letter.source_partition, letter.source_offset) == ("txn.api", 3, 7)
    assert bytes(letter.original_payload_bytes) == value and letter.transaction_id is None


def test_good_frame_and_large_schema_id(spark):
    decoded = decode(spark, framed(json.dumps(BODY).encode(), 2**32 - 1), expected_schema_id=2**32 - 1)
    row = frame.decoded_rows(decoded).first()
    assert (row.transaction_id, str(row.amount), row.event_time, row.geo_lat) == ("txn-001", "49.9900", T0, None)


def test_encode_round_trip(spark):
    df = spark.createDataFrame([("a", 1)], "s string, n int")
    value = bytes(frame.encode(df, 258, "json").first().value)
    assert value[:5] == b"\x00\x00\x00\x01\x02" and json.loads(value[5:]) == {"s": "a", "n": 1}


def test_late_letter(spark):
    df = spark.createDataFrame(
        [("t", "txn.api", 1, 2, 1_699_999_990_000, 1_700_000_000_000, True)],
        "transaction_id string, source_topic string, source_partition int, source_offset bigint, "
        "event_time bigint, watermark bigint, is_late boolean",
    )
    letters = dlq.late_events(df, 30_000)
    assert quality.schema_differences(letters.schema, schemas.PROC_DLQ) == []
    row = letters.first()
    assert row.error_message == "event_time=1699999990000 is 10000ms behind watermark (allowed=30000ms)"
    assert (row.watermark_at_rejection, row.event_time_at_rejection) == (1_700_000_000_000, 1_699_999_990_000)
    assert json.loads(bytes(row.original_payload_bytes)) == {"transaction_id": "t", "event_time": 1_699_999_990_000}


def test_stable_ids(spark):
    df = spark.range(3).select(F.lit("t").alias("source_topic"), F.lit(0).alias("source_partition"),
                               F.col("id").alias("source_offset"))
    ids = [r[0] for r in df.select(dlq.stable_id(F.lit("late"))).collect()]
    assert len(set(ids)) == 3 and ids == [r[0] for r in df.select(dlq.stable_id(F.lit("late"))).collect()]


def test_contracts():
    assert len(schemas.ENRICHED.fields) == 35 and len(schemas.TXN.fields) == 17
    assert len(schemas.PROC_DLQ.fields) == 13 and len(schemas.INGEST_DLQ.fields) == 8
    for contract in (schemas.ENRICHED, schemas.TXN):
        assert not set(schemas.FORBIDDEN_FIELDS) & set(contract.fieldNames())
    found = json.loads(schemas.avro_schema(schemas.ENRICHED, "E", schemas.ENUMS))
    kinds = {f["name"]: f["type"] for f in found["fields"]}
    assert kinds["amount"] == {"type": "bytes", "logicalType": "decimal", "precision": 18, "scale": 4}
    assert kinds["geo_network_class"][1]["symbols"] == list(schemas.NETWORK_CLASSES)
    assert kinds["device_first_seen"] == ["null", "long"] and kinds["vel_count_1m"] == "int"


def test_schema_differences(spark):
    df = spark.createDataFrame([(1, "x")], "transaction_id int, card_number string")
    found = quality.schema_differences(df.schema, schemas.TXN)
    assert "forbidden column card_number" in found and "column transaction_id is int, not string" in found


def test_messages(spark):
    df = spark.createDataFrame([("acc", None)], "account_id string, city string")
    row = event_log.keyed_json(df).first()
    assert (row.key, row.value) == ("acc", '{"account_id":"acc","city":null}')
    letters = dlq.schema_failures(decode(spark, b""))
    headers = event_log.with_error_header(letters).first().headers
    assert [(h.key, bytes(h.value)) for h in headers] == [("error_type", schemas.SCHEMA_ERROR.encode())]


def test_config_from_environment(monkeypatch):
    monkeypatch.setenv("WATERMARK_OOO_SECONDS", "7")
    monkeypatch.setenv("ALLOWED_LATENESS_SECONDS", "9")
    cfg = ProcessorConfig.from_env()
    assert (cfg.watermark_ms, cfg.lateness_ms, cfg.input_topic) == (7000, 9000, "txn.api")


def test_generated_payloads_are_all_accepted(spark):
    made = generate(spark, 2000, T0)
    events, letters = ingest(made, now_ms=F.col("event_time"))
    assert (events.count(), letters.count()) == (2000, 0)
    spread = made.agg(*[F.count_distinct(c).alias(c) for c in ("transaction_id", "account_id", "caller_ip", "merchant_id")]).first()
    assert (spread.transaction_id, spread.account_id, spread.merchant_id) == (2000, ACCOUNTS, SHOPS)
    assert len(NETWORKS) * HOSTS * 0.8 < spread.caller_ip <= len(NETWORKS) * HOSTS
    cents = made.agg(F.min(F.col("amount").cast("double")), F.max(F.col("amount").cast("double"))).first()
    assert 1 <= cents[0] < 50 and 4900 < cents[1] <= 5000


def test_replay_selects_by_coordinates(spark):
    log = tables.log_records(tables.transactions(spark, SF))
    letters = dlq.schema_failures(frame.decode(log, "json", 1))
    one = letters.select(*schemas.SOURCE.fieldNames()).limit(1)
    assert dlq.replay_selection(letters, one).count() == 1


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_computed_value_is_worked_out_once_per_filter(spark):
    """A filter takes over the expressions it names; value must not be repeated in them."""
    log = spark.range(5).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.concat(F.unhex(F.lit("0000000001")), F.soundex(F.col("id").cast("string")).cast("binary")).alias("value"),
    )
    bad = frame.decode(log, "json", 1).where(F.col("decode_error").isNotNull())
    assert bad.count() == 5
    filters = [line for line in optimized(bad).split("\n") if "Filter " in line]
    assert [line.count("soundex") for line in filters] == [1]


def test_replay_reads_the_letters_and_not_the_log_again(spark):
    """The log is decoded once, for the letters; what is selected and replayed comes from their table."""
    again = driver_queries.QUERIES["replay_mismatched_schema"](spark, SF)
    assert "event_type" not in optimized(again) and again.count() > 0

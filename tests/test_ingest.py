import json

import pytest
from support import T0
from pyspark.sql import functions as F

from tollgate.config import IngestConfig, MaskingConfig
from tollgate.operators.ingest import accepted_events, assert_no_card_column, mask_payloads, rejects
from tollgate.operators.quality import pii_audit, schema_differences
from tollgate.plans.ingestion import ingest
from tollgate.schemas import INGEST_DLQ, RAW_PAYLOAD, TXN

GOOD = {
    "transaction_id": "f47ac10b-58cc-4372-a567-0e02b2c3d479",
    "account_id": "acc_001",
    "merchant_id": "mch_xyz",
    "amount": "49.99",
    "currency": "USD",
    "card_number": "4111111111111111",
    "caller_ip": "203.0.113.45",
    "api_key_id": "key_abc123",
    "oauth_scope": "transactions:write",
    "event_time": T0,
    "channel": "WEB",
    "geo_lat": 51.5,
    "geo_lon": -0.1,
}


def mask(spark, cfg=None, **changes):
    payload = {**GOOD, **changes}
    df = spark.createDataFrame([tuple(payload[n] for n in RAW_PAYLOAD.fieldNames())], RAW_PAYLOAD)
    return mask_payloads(df, cfg, F.lit(T0).cast("bigint"))


def test_good_payload(spark):
    event = accepted_events(mask(spark))
    assert event.schema.fieldNames() == TXN.fieldNames()
    row = event.first()
    assert (row.card_bin, row.card_last4, row.caller_ip_subnet) == ("411111", "1111", "203.0.113.0")
    assert (str(row.amount), row.channel, row.processing_time) == ("49.9900", "API", T0)
    assert (row.masking_lib_version, row.schema_version) == ("1.0.0", "1")
    assert row.geo_lat == 51.5


@pytest.mark.parametrize(
    ("changes", "kind", "message"),
    [
        ({"account_id": ""}, "ValidationError", "Missing required fields: ['account_id']"),
        ({"account_id": None, "event_time": 0}, "ValidationError", "Missing required fields: ['account_id', 'event_time']"),
        ({"amount": "-1"}, "ValidationError", "Field validation errors: ['amount must be > 0']"),
        ({"amount": "0"}, "ValidationError", "Field validation errors: ['amount must be > 0']"),
        ({"amount": "ten"}, "ValidationError", "Field validation errors: ['amount must be a numeric value']"),
        ({"amount": "nan"}, "ValidationError", "Field validation errors: ['amount must be a numeric value']"),
        ({"amount": "100000000000000"}, "ValidationError", "Field validation errors: ['amount is out of range']"),
        ({"currency": "US", "channel": "FAX"}, "ValidationError",
         "Field validation errors: ['currency must be a 3-character ISO-4217 code', "
         "'channel must be one of ['API', 'MOBILE', 'POS', 'WEB']']"),
        ({"event_time": T0 - 300_001}, "ValidationError",
         "Field validation errors: ['event_time is more than 5 minutes from server time']"),
        ({"card_number": "1234567890123456"}, "InvalidPANError", "Luhn check failed"),
        ({"card_number": "4111-x"}, "InvalidPANError", "PAN contains non-digit characters"),
        ({"caller_ip": "224.0.0.1"}, "MaskingError", "IP masking failed: multicast addresses must not be stored"),
        ({"caller_ip": "nonsense"}, "MaskingError", "IP masking failed: not an IPv4 or IPv6 address"),
    ],
)
def test_faults(spark, changes, kind, message):
    row = mask(spark, **changes).first()
    assert (row.error_type, row.error_message, row.masking_applied) == (kind, message, False)


def test_skew_of_exactly_five_minutes_passes(spark):
    assert mask(spark, event_time=T0 - 300_000).first().error_type is None


def test_leak_guard_names_the_field(spark):
    row = mask(spark, merchant_id="4000123412341234").first()
    assert row.error_type == "MaskingError" and row.masking_applied
    assert row.error_message == (
        "PII LEAK: field 'merchant_id' contains a full card-number-length digit sequence"
    )
    with pytest.raises(ValueError):
        assert_no_card_column(RAW_PAYLOAD)


def test_rejects_carry_no_card_or_address(spark):
    letters = rejects(mask(spark, card_number="1234567890123456"))
    assert schema_differences(letters.schema, INGEST_DLQ) == []
    row = letters.first()
    assert (row.error_type, row.masking_applied, row.source_topic) == ("InvalidPANError", False, "txn.api")
    payload = json.loads(row.original_payload)
    assert payload["transaction_id"] == GOOD["transaction_id"]
    assert "card_number" not in payload and "caller_ip" not in payload
    assert "1234567890123456" not in str(row) and "203.0.113.45" not in str(row)


def test_options(spark):
    assert accepted_events(mask(spark, IngestConfig(keep_channel=True))).first().channel == "WEB"
    cfg = IngestConfig(masking=MaskingConfig(ipv4_prefix=16))
    assert accepted_events(mask(spark, cfg)).first().caller_ip_subnet == "203.0.0.0"
    uuid_cfg = IngestConfig(require_uuid=True)
    assert mask(spark, uuid_cfg).first().error_type is None
    assert "UUID" in mask(spark, uuid_cfg, transaction_id="txn-1").first().error_message


def test_absent_columns_are_missing_fields(spark):
    row = mask_payloads(spark.createDataFrame([("a",)], "account_id string")).first()
    assert row.error_message.startswith("Missing required fields: ['transaction_id', 'merchant_id'")


def test_plan_splits_every_row_and_needs_no_shuffle(spark):
    df = spark.createDataFrame(
        [tuple({**GOOD, "amount": a}[n] for n in RAW_PAYLOAD.fieldNames()) for a in ("1", "0", "x")], RAW_PAYLOAD
    )
    events, letters = ingest(df, now_ms=F.lit(T0).cast("bigint"))
    assert (events.count(), letters.count()) == (1, 2)
    assert "Exchange" not in events._jdf.queryExecution().executedPlan().toString()
    assert pii_audit(events).where("violations > 0").count() == 0

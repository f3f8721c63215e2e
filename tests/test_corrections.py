"""Corrections over tables stored by day, and the batch plan of the second stage."""

import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from support import HOT, SF, SKEWS, T0

import driver_tables as tables
from tollgate.config import DAY_MS, HOUR_MS, ProcessorConfig
from tollgate.operators import velocity as vel
from tollgate.operators.quality import corrections, corrections_by_day, event_day
from tollgate.plans.processing import process
from tollgate.schemas import VELOCITY

FEATURES = ["transaction_id", "event_time", *VELOCITY.fieldNames()]
LATER = T0 + 90 * DAY_MS


def stored(df, path):
    """A table with a folder per day of event time."""
    df.withColumn("event_day", event_day(F.col("event_time"))).write.partitionBy("event_day").parquet(path)
    return df.sparkSession.read.parquet(path)


def emitted_records(df):
    return vel.velocity(df).withColumn("enrichment_time", F.lit(T0))


def spread_items(days=12):
    """Two busy accounts: a row every four hours, and bursts inside one minute."""
    return [
        (account, "k", T0 + day * DAY_MS + hour * HOUR_MS + i, i + 1)
        for account in ("a", "b")
        for day in range(days)
        for hour in range(0, 24, 4)
        for i in range(2)
    ]


def is_late():
    """Two rows of one account, at both ends of a day and nine days apart."""
    hours = F.floor((F.col("event_time") - T0) / HOUR_MS)
    return (F.col("account_id") == "a") & hours.isin(20, 9 * 24)


@pytest.mark.parametrize("skew", SKEWS)
def test_only_touched_days_are_read(spark, rows, tmp_path, skew):
    everything = rows(spread_items())
    emitted = emitted_records(everything.where(~is_late()))
    late = everything.where(is_late())
    expected = corrections(everything, emitted, late, F.lit(LATER), skew).select(*FEATURES).collect()
    events = stored(everything, f"{tmp_path}/events")
    records = stored(emitted, f"{tmp_path}/emitted")
    first = T0 // DAY_MS
    # the late rows lie on days 0 and 9; windows of the days after them reach two days back
    for name, read in (("emitted", {0, 1, 9, 10}), ("events", {0, 1, 7, 8, 9, 10})):
        for day in set(range(12)) - read:
            files = glob.glob(f"{tmp_path}/{name}/event_day={first + day}/*.parquet")
            assert files
            for file in files:
                with open(file, "wb") as broken:
                    broken.write(b"not a table")
    found = corrections_by_day(events, records, late, F.lit(LATER), skew=skew).select(*FEATURES).collect()
    assert sorted(found) == sorted(expected) and len(found) > 10


def test_no_late_row_corrects_nothing(rows, tmp_path):
    everything = rows(spread_items(2))
    events = stored(everything, f"{tmp_path}/events")
    records = stored(emitted_records(everything), f"{tmp_path}/emitted")
    lost = rows([(None, "k", T0, 1), ("a", "k", None, 1)])
    assert corrections_by_day(events, records, lost, F.lit(LATER)).count() == 0
    assert corrections_by_day(events, records, lost.where("false"), F.lit(LATER)).count() == 0


def test_a_returned_id_is_corrected_by_its_own_time(spark, rows, tmp_path):
    """An id that came back days later keeps a record for each of its times."""
    items = [("a", "k", T0, 1), ("a", "k", T0 + HOUR_MS, 2), ("a", "k", T0 + 5 * DAY_MS, 3)]
    everything = rows(items).withColumn(
        "transaction_id", F.when(F.col("source_offset") == 0, "t0").otherwise("again")
    )
    late = F.col("transaction_id") == "t0"
    events = stored(everything, f"{tmp_path}/events")
    emitted = emitted_records(everything.where(~late))
    corrected = emitted.withColumn("vel_count_24h", F.lit(9)).withColumn("enrichment_time", F.lit(T0 - 1))
    records = stored(emitted.unionByName(corrected), f"{tmp_path}/emitted")
    found = corrections_by_day(events, records, everything.where(late), F.lit(LATER)).collect()
    assert [(r.event_time, r.vel_count_24h, r.vel_amount_24h) for r in found] == [
        (T0 + HOUR_MS, 2, Decimal("3.0000"))
    ]


CFG = ProcessorConfig(expected_schema_id=tables.LOG_SCHEMA_ID)


def total(done):
    return {r.counter: r.total for r in done.counters.collect()}


def test_every_log_record_ends_once(spark):
    """One letter per offset, and every offset is a letter, a record or a dropped repeat."""
    rows = tables.transactions(spark, SF, repeats=tables.NEAR_REPEATS)
    log = tables.log_records(rows)
    done = process(log, tables.blocks(spark), CFG, tables.enrichment_clock(), "json", failed_at=F.lit(7))
    letters = done.letters.collect()
    places = [(r.source_topic, r.source_partition, r.source_offset) for r in letters]
    assert len(set(places)) == len(places) and len({r.dlq_id for r in letters}) == len(letters)
    assert {r.failed_at for r in letters} == {7}
    count = total(done)
    kinds = {kind: sum(r.error_type == kind for r in letters) for kind in {r.error_type for r in letters}}
    assert kinds == {k: v for k, v in count.items() if k in kinds}
    assert count["read"] == log.count() == len(letters) + count["records"] + count["repeats_dropped"]
    assert count["records"] == done.records.count() and count["repeats_dropped"] > 0
    sent = {(r.partition, r.offset): bytes(r.value) for r in log.collect()}
    for r in letters:  # no overflow here, so every letter keeps the record's own bytes
        assert bytes(r.original_payload_bytes) == sent[r.source_partition, r.source_offset]


def test_an_empty_log_gives_empty_tables(spark):
    log = tables.log_records(tables.transactions(spark, SF)).where("offset < 0")
    done = process(log, tables.blocks(spark), CFG, body="json")
    assert done.records.count() == 0 and done.letters.count() == 0
    assert set(total(done).values()) == {0}


def test_a_log_of_failures_only(spark):
    log = tables.log_records(tables.transactions(spark, SF)).limit(50).withColumn("value", F.lit(b"\x01"))
    log = log.withColumn("value", F.when(F.col("offset") % 2 == 0, F.col("value")))  # some are null
    done = process(log, tables.blocks(spark), CFG, body="json")
    assert total(done)["SCHEMA_VALIDATION_ERROR"] == total(done)["read"] == done.letters.count() == 50
    assert done.records.count() == 0


def test_hot_keys_go_through_the_whole_stage(spark):
    """Everything hot gives the same records."""
    from dataclasses import replace

    log = tables.log_records(tables.transactions(spark, SF, repeats=tables.NEAR_REPEATS)).where("partition < 3")
    one, other = (
        process(log, tables.blocks(spark), cfg, tables.enrichment_clock(), "json").records.select(*FEATURES).collect()
        for cfg in (CFG, replace(CFG, skew=HOT))
    )
    assert sorted(one) == sorted(other) and one

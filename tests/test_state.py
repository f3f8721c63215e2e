"""Device history, deduplication, lateness and location."""

import random
from decimal import Decimal

import pytest
from support import HOT, SKEWS, T0
from pyspark.sql import functions as F
from pyspark.sql import types as T

import driver_tables as tables
from tollgate.config import DAY_MS, HOUR_MS, ProcessorConfig
from tollgate.operators.dedup import TTL_MS, dedup, first_per_id, latest_per_id
from tollgate.operators.device import IDLE_MS, device_profile, device_snapshot
from tollgate.operators.geo import geolocate, network_blocks
from tollgate.operators.lateness import with_watermark_and_lateness
from tollgate.plans.enrichment import enrich_all
from tollgate.schemas import DECODED, DEVICE, GEO, SOURCE
from tollgate.sources.geo_blocks import read_blocks


def devices(df):
    return {r.transaction_id: tuple(r[c] for c in DEVICE.fieldNames()) for r in df.collect()}


@pytest.mark.parametrize("skew", SKEWS)
def test_device_counts_and_idle_gap(rows, skew):
    items = [("a", "k", T0 + i, 1) for i in range(21)]
    items += [("a", "k", T0 + 20 + IDLE_MS, 1), ("a", "k", T0 + 21 + 2 * IDLE_MS, 1)]
    items += [("a", None, T0, 1), ("a", "", T0, 1), ("a", "other", T0 + 3, 1)]
    found = devices(device_profile(rows(items), skew))
    assert found["t0"] == (T0, 1, False)
    assert found["t20"] == (T0, 21, False)
    assert found["t21"] == (T0, 22, False)  # exactly the limit is not idle
    assert found["t22"] == (T0 + 21 + 2 * IDLE_MS, 1, False)  # one ms more is
    assert found["t23"] == found["t24"] == (None, None, None)
    assert found["t25"] == (T0 + 3, 1, False)


def test_active_device_outlives_the_limit(rows):
    items = [("a", "k", T0 + i * 5 * DAY_MS, 1) for i in range(4)]
    assert devices(device_profile(rows(items)))["t3"] == (T0, 4, False)


def test_device_snapshot(rows):
    found = device_snapshot(rows([("a", "k", T0, 1), ("a", "k", T0 + 9, 1), ("a", None, T0, 1)]))
    assert [tuple(r) for r in found.collect()] == [("k", T0, 2, T0 + 9)]


def arrivals(spark, items):
    data = [(name, time, 0, i) for i, (name, time) in enumerate(items)]
    return spark.createDataFrame(
        data, "transaction_id string, event_time bigint, source_partition int, source_offset bigint"
    )


def kept_by_hand(items):
    last, kept = {}, []
    for i in sorted(range(len(items)), key=lambda i: (items[i][1], i)):
        name, time = items[i]
        if name not in last or time - last[name] >= TTL_MS:
            last[name] = time
            kept.append(i)
    return sorted(kept)


def test_dedup_within_the_ttl(spark):
    items = [("t", 1000), ("t", 2000), ("a", 1), ("b", 1), ("t", 1000 + TTL_MS - 1)]
    found = dedup(arrivals(spark, items))
    assert sorted(r.source_offset for r in found.collect()) == [0, 2, 3]


def test_dedup_chain_of_many_returns(spark):
    random.seed(5)
    items = [("chain", int(i * TTL_MS * 0.4)) for i in range(25)]
    items += [("once", 5), ("exact", 0), ("exact", TTL_MS), ("exact", TTL_MS)]
    items += [(random.choice("xyz"), random.randrange(12 * TTL_MS)) for _ in range(80)]
    found = dedup(arrivals(spark, items))
    assert sorted(r.source_offset for r in found.collect()) == kept_by_hand(items)


def test_dedup_sends_one_row_per_id_and_task(spark):
    plan = first_per_id(arrivals(spark, [("t", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_latest_per_id(spark):
    df = spark.createDataFrame([("t", 1), ("t", 5), ("u", 2)], "transaction_id string, enrichment_time bigint")
    assert sorted(map(tuple, latest_per_id(df).collect())) == [("t", 5), ("u", 2)]


def test_lateness_by_hand(spark):
    random.seed(2)
    items = [("t", T0 + i * 1000 - random.choice([0, 0, 0, 39_000, 41_000, 90_000])) for i in range(120)]
    df = arrivals(spark, items).withColumn("source_partition", (F.col("source_offset") % 2).cast("int"))
    found = {r.source_offset: (r.watermark, r.is_late) for r in with_watermark_and_lateness(df, ProcessorConfig(), 7).collect()}
    high = {}
    for i, (_, time) in enumerate(items):
        mark = high[i % 2] - 10_000 if i % 2 in high else None
        assert found[i] == (mark, mark is not None and time < mark - 30_000)
        high[i % 2] = max(high.get(i % 2, 0), time)


BLOCKS = [
    ("203.0.0.0/8", "AU", None),
    ("203.0.113.0/24", "US", "New York"),
    ("203.0.113.1/32", "US", "Queens"),
    ("198.51.0.0/16", "NL", None),
    ("2001:db8::/32", "DE", None),
    ("2001:db8:1:2::/64", "DE", "Berlin"),
    ("not a network", "XX", None),
    ("1.2.3.4/99", "XX", None),
]


@pytest.mark.parametrize("skew", SKEWS)
def test_longest_prefix_wins(spark, skew):
    blocks = network_blocks(spark.createDataFrame(BLOCKS, "network string, country string, city string"))
    subnets = ["203.0.113.0", "203.0.113.0/24", "203.0.113.5", "203.9.9.0", "198.51.100.0", "8.8.8.0",
               "2001:db8:1:2::", "2001:db8:9::", "fe80::", "junk", None]
    df = spark.createDataFrame([(s, 0, i) for i, s in enumerate(subnets)] * 3,
                               "caller_ip_subnet string, source_partition int, source_offset bigint")
    found = geolocate(df, blocks, skew)
    assert found.count() == 3 * len(subnets)
    place = {r.caller_ip_subnet: (r.geo_country, r.geo_city, r.geo_network_class) for r in found.collect()}
    home = "RESIDENTIAL"
    assert place["203.0.113.0"] == place["203.0.113.0/24"] == ("US", "Queens", home)
    assert place["203.0.113.5"] == ("US", "New York", home)
    assert place["203.9.9.0"] == ("AU", None, home)
    assert place["198.51.100.0"] == ("NL", None, home)
    assert place["2001:db8:1:2::"] == ("DE", "Berlin", home)
    assert place["2001:db8:9::"] == ("DE", None, home)
    assert place["8.8.8.0"] == place["fe80::"] == place["junk"] == place[None] == (None, None, None)


def test_confidence_rules(spark):
    blocks = network_blocks(spark.createDataFrame(BLOCKS, "network string, country string, city string"))
    df = spark.createDataFrame([("203.0.113.5", 0, 0), ("203.9.9.0", 0, 1)],
                               "caller_ip_subnet string, source_partition int, source_offset bigint")
    fixed = {round(r.geo_confidence, 6) for r in geolocate(df, blocks).collect()}
    assert fixed == {0.9}
    precise = {r.caller_ip_subnet: r.geo_confidence for r in geolocate(df, blocks, HOT, "precision").collect()}
    assert precise == {"203.0.113.5": 1.0, "203.9.9.0": 0.5}


def test_missing_block_table_gives_nulls(spark, tmp_path):
    df = spark.createDataFrame([("203.0.113.0", 0, 0)],
                               "caller_ip_subnet string, source_partition int, source_offset bigint")
    for path in (None, str(tmp_path / "nowhere")):
        row = geolocate(df, read_blocks(spark, path)).first()
        assert [row[c] for c in GEO.fieldNames()] == [None] * 4


def test_block_table_from_csv(spark, tmp_path):
    (tmp_path / "b.csv").write_text("network,country,city\n10.0.0.0/8,US,\n")
    assert [tuple(r) for r in read_blocks(spark, str(tmp_path), "csv").collect()] == [
        (32, 8, "00001010", "US", None)
    ]


@pytest.mark.parametrize("skew", SKEWS)
def test_features_beyond_the_contract_become_dead_letters(spark, skew):
    most = Decimal("99999999999999.9999")
    fields = {f.name: None for f in [*SOURCE.fields, *DECODED.fields]}
    common = {**fields, "source_topic": "txn", "source_partition": 0, "account_id": "a", "currency": "EUR", "processing_time": T0}
    data = [
        {**common, "source_offset": i, "transaction_id": name, "event_time": T0 + i, "amount": amount, "account_id": account}
        for i, (name, account, amount) in enumerate([("x", "a", most), ("y", "a", most), ("z", "b", Decimal(1))])
    ]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in [*SOURCE.fields, *DECODED.fields]])
    rows = spark.createDataFrame([tuple(d[f.name] for f in schema.fields) for d in data], schema)
    records, letters = enrich_all(rows, tables.blocks(spark), ProcessorConfig(skew=skew), F.lit(T0 + 5))
    assert sorted(r.transaction_id for r in records.collect()) == ["x", "z"]
    letter = letters.collect()
    assert [(r.transaction_id, r.error_type) for r in letter] == [("y", "ENRICHMENT_EXCEPTION")]
    assert letter[0].error_message.startswith("vel_amount_1m")

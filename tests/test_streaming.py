import json
import os
import random
from decimal import Decimal

import pytest
from support import SF, SKEWS, T0
from pyspark.sql import functions as F

import driver_tables as tables
from tollgate import schemas
from tollgate.config import DAY_MS, ProcessorConfig
from tollgate.session import fresh_path, path_exists, ship_package, state_settings
from tollgate.sources import event_log
from tollgate.streaming.commits import Commits
from tollgate.config import SkewConfig
from tollgate.streaming.device import SEGMENTS, batch_device, next_segments
from tollgate.streaming.dedup import ACCEPTED, batch_dedup, near_times, next_times, start_dedup
from tollgate.streaming.enrich import stream_dedup, write_batch
from tollgate.streaming.velocity import FAN, PARTIALS, batch_velocity, joined_pieces, live_pieces, next_piece
from tollgate.streaming.progress import ProgressLog, progress_frame, watermark_age
from tollgate.streaming.route import route_batch, start_route

ROW = (
    "transaction_id string, account_id string, api_key_id string, event_time bigint, "
    "amount decimal(18,4), source_partition int, source_offset bigint"
)


def run(spark, batches, build, rows=False):
    """Feed one file set per batch to a query over ROW files; each batch is a restart."""
    root = fresh_path(spark, "test-stream")
    ship_package(spark)
    number = 0
    for batch in batches:
        data = []
        for name, account, key, time, amount in batch:
            data.append((name, account, key, time, Decimal(str(amount)), 0, number))
            number += 1
        spark.createDataFrame(data, ROW).write.mode("append").parquet(f"{root}/in")
        with state_settings(spark):
            (
                build(spark.readStream.schema(ROW).parquet(f"{root}/in"))
                .writeStream.option("checkpointLocation", f"{root}/checkpoint")
                .format("parquet")
                .option("path", f"{root}/out")
                .trigger(availableNow=True)
                .start()
                .awaitTermination()
            )
    found = spark.read.parquet(f"{root}/out").collect()
    return found if rows else {r.transaction_id: r for r in found}


def simulate(batches):
    """Minute buckets by arrival: later buckets count too."""
    buckets, result = {}, {}
    for name, account, _, time, amount in [row for batch in batches for row in batch]:
        own = buckets.setdefault(account, {})
        minute = time // 60_000
        count, total = own.get(minute, (0, Decimal(0)))
        own[minute] = (count + 1, total + Decimal(str(amount)))
        features = []
        for _, minutes in schemas.VELOCITY_WINDOWS:
            seen = [v for m, v in own.items() if m >= minute - minutes]
            features += [sum(v[0] for v in seen), sum(v[1] for v in seen)]
        result[name] = features
    return result


@pytest.mark.parametrize("block_rows", [1, 7, 65_536])
def test_velocity_counts_later_buckets_of_out_of_order_rows(spark, block_rows):
    """One account has a third of the rows; with small blocks it is cut into many chunks."""
    ship_package(spark)
    rng = random.Random(block_rows)
    rows = []
    for i in range(900):
        account = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        minute = rng.choice([0, 1, 4, 5, 6, 59, 61, 1440, 1441, 3000]) + i // 50
        rows.append((f"t{i}", account, "k", T0 + minute * 60_000 + i, rng.choice([i + 1, "0.0001", "99999999.9999"])))
    batches = [rows[:500], rows[500:505], rows[505:]]
    state, found, number = spark.createDataFrame([], PARTIALS), {}, 0
    for batch in batches:
        data = [(*row[:4], Decimal(str(row[4])), 0, number + i) for i, row in enumerate(batch)]
        number += len(batch)
        frame = spark.createDataFrame(data, ROW).repartition(4)
        counted = batch_velocity(frame, state, SkewConfig(block_rows=block_rows)).collect()
        found |= {r.transaction_id: r for r in counted}
        merged = next_piece(frame, state, None, 0).collect()
        state = spark.createDataFrame(merged, PARTIALS)
    names = schemas.VELOCITY.fieldNames()
    assert {n: [r[c] for c in names] for n, r in found.items()} == simulate(batches)


def test_velocity_features_beyond_the_contract_are_null(spark):
    ship_package(spark)
    state = spark.createDataFrame(
        [("a", T0 // 60_000 - 3, 2**31 - 1, Decimal("9" * 30 + ".9999")), ("b", T0 // 60_000, 1, Decimal("1.5"))], PARTIALS
    )
    rows = spark.createDataFrame([("x", "a", "k", T0, Decimal(1), 0, 1), ("y", "b", "k", T0, Decimal(1), 0, 2)], ROW)
    found = {r.transaction_id: r for r in batch_velocity(rows, state).collect()}
    assert (found["x"].vel_count_1m, found["x"].vel_count_5m, found["x"].vel_amount_24h) == (1, None, None)
    assert (found["y"].vel_count_1m, found["y"].vel_amount_24h) == (2, Decimal("2.5000"))


def test_pieces_of_the_state_hold_every_batch_once():
    held = {}  # piece -> batches in it
    for batch in range(FAN**2 * 2 + 40):
        live = live_pieces(batch)
        assert sorted(b for piece in live for b in held[piece]) == list(range(batch)) and len(live) < 3 * FAN
        gone = joined_pieces(batch)
        held[batch] = [b for piece in gone for b in held.pop(piece)] + [batch]


def test_old_minutes_leave_the_state(spark):
    rows = spark.createDataFrame([("x", "a", "k", T0, Decimal(1), 0, 1)], ROW)
    minutes = [T0 // 60_000 - 3000, T0 // 60_000 - 1400]
    old = spark.createDataFrame([("a", m, 1, Decimal(1)) for m in minutes], PARTIALS)
    kept = next_piece(rows, old, T0, 30_000).collect()
    assert sorted(r.minute for r in kept) == [minutes[1], T0 // 60_000]


def history_of(spark, batches, skew=None, idle_ms=7 * DAY_MS, clock=None, join=False):
    """Device columns of rows (name, device, time) by batch; each batch adds a piece or replaces all."""
    pieces, found = [], {}
    for batch in batches:
        data = [(name, "a", key, time, Decimal(1), 0, i) for i, (name, key, time) in enumerate(batch)]
        frame = spark.createDataFrame(data, ROW).repartition(4)
        state = spark.createDataFrame([row for piece in pieces for row in piece], SEGMENTS)
        for row in batch_device(frame, state, skew, idle_ms).collect():
            found[row.transaction_id] = tuple(row[c] for c in schemas.DEVICE.fieldNames())
        nothing = spark.createDataFrame([], SEGMENTS)
        if join:
            pieces = [next_segments(frame, state, nothing, clock, 0, idle_ms).collect()]
        else:
            pieces.append(next_segments(frame, None, state, clock, 0, idle_ms).collect())
    return found, [row for piece in pieces for row in piece]


def sessions_by_hand(batches, idle_ms):
    """A row's session is what the rows of earlier batches and those up to it in its own are chained to."""
    before, found = {}, {}
    for batch in batches:
        for place, (name, key, time) in enumerate(batch):
            if not key:
                found[name] = (None, None, None)
                continue
            own = [t for i, (_, k, t) in enumerate(batch) if k == key and (t, i) <= (time, place)]
            chain = sorted(before.get(key, []) + own)
            at = chain.index(time)
            low = high = at
            while low > 0 and chain[low] - chain[low - 1] <= idle_ms:
                low -= 1
            while high + 1 < len(chain) and chain[high + 1] - chain[high] <= idle_ms:
                high += 1
            found[name] = (chain[low], high - low + 1, False)
        for _, key, time in batch:
            before.setdefault(key, []).append(time)
    return found


@pytest.mark.parametrize(
    "idle_ms, skew, join", [(60_000, SKEWS[0], False), (3 * 3_600_000, SKEWS[1], True), (7 * DAY_MS, SKEWS[0], True)]
)
def test_device_sessions_over_batches_out_of_order(spark, idle_ms, skew, join):
    """Sessions begin, meet and are bridged in any order; one device has a third of the rows."""
    rng, batches = random.Random(idle_ms), []
    for number in range(3):
        keys = ["hot", rng.choice(["a", "b", "c", None, ""]), rng.choice(["d", "e"])]
        span = 40 * idle_ms if number % 2 else 12 * idle_ms
        steps = [0, 1, idle_ms - 1, idle_ms, idle_ms + 1]
        batches.append([
            (f"t{number}-{i}", keys[i % 3] if i % 3 == 0 else rng.choice([*"abcde", None, ""]),
             T0 + rng.randrange(0, span, idle_ms) + rng.choice(steps))
            for i in range(60)
        ])
    found, _ = history_of(spark, batches, skew, idle_ms, join=join)
    assert found == sessions_by_hand(batches, idle_ms)


def test_ended_sessions_leave_the_state_and_others_hold_them_together(spark):
    day = DAY_MS
    rows = spark.createDataFrame([("x", "a", "k", T0 + 30 * day, Decimal(1), 0, 1)], ROW)
    replaced = [("k", T0 + d * day, T0 + d * day, 2) for d in (0, 10, 12)] + [("gone", T0, T0 + 5 * day, 9)]
    replaced = spark.createDataFrame([*replaced, ("bridged", T0, T0 + day, 3), ("bridged", T0 + 14 * day, T0 + 14 * day, 1)], SEGMENTS)
    others = spark.createDataFrame([("bridged", T0 + 7 * day, T0 + 25 * day, 4)], SEGMENTS)
    kept = next_segments(rows, replaced, others, T0 + 30 * day, 0).collect()
    assert sorted(map(tuple, kept)) == [("bridged", T0, T0 + 14 * day, 4), ("k", T0 + 30 * day, T0 + 30 * day, 1)]
    everything = next_segments(rows, replaced, others, None, 0).collect()
    assert sorted(r.cnt for r in everything) == [1, 2, 4, 4, 9]


def test_five_devices_use_all_tasks(spark):
    data = [(f"t{i}", "a", f"k{i % 5}", T0 + i * 60_000, Decimal(1), 0, i) for i in range(2000)]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        state = spark.createDataFrame([("k1", T0 - 5, T0 - 5, 1)], SEGMENTS)
        found = batch_device(spark.createDataFrame(data, ROW), state)
        tasks = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in tasks) < 2 * len(data) / len(tasks)


def test_package_is_sent_once(spark):
    """A cluster refuses a second archive of the same name from another folder."""
    ship_package(spark)
    before = sorted(spark.sparkContext.listFiles)
    ship_package(spark)
    assert sorted(spark.sparkContext.listFiles) == before


def test_stream_dedup_over_restarts(spark):
    batches = [[("t", "a", "k", T0, 1), ("t", "a", "k", T0 + 1, 1)], [("t", "a", "k", T0 + DAY_MS, 1), ("u", "a", "k", T0, 1)]]
    found = run(spark, batches, routed)
    assert sorted(found) == ["t", "u"]


def test_stream_dedup_accepts_returns_and_slow_partitions(spark):
    hour = 3_600_000
    batches = [
        [("t", "a", "k", T0, 1), ("future", "a", "k", T0 + 10_000 * hour, 1)],
        [("t", "a", "k", T0 + 47 * hour, 2), ("slow", "a", "k", T0 - 90 * hour, 1)],
        [("t", "a", "k", T0 + 60 * hour, 3), ("slow", "a", "k", T0 - 89 * hour, 2)],
        [("t", "a", "k", T0 + 107 * hour, 4), ("u", "a", "k", T0, 1)],
    ]
    times = kept_times(spark, batches)
    assert times["t"] == [T0, T0 + 60 * hour]
    assert times["slow"] == [T0 - 90 * hour] and len(times["future"]) == len(times["u"]) == 1


def test_stream_dedup_drops_copies_of_an_early_row_after_a_later_one(spark):
    hour = 3_600_000
    rows = [("t", "a", "k", T0 + h * hour, h) for h in (60, 0, 0, 0, 10, 12, 60, 108, 107)]
    for batches in ([rows], [rows[:1], rows[1:3], rows[3:]]):
        assert kept_times(spark, batches)["t"] == [T0, T0 + 60 * hour, T0 + 108 * hour]


def accepted_by_hand(batches, ttl):
    accepted, kept = {}, []
    for place, (name, time) in enumerate(row for batch in batches for row in batch):
        own = accepted.setdefault(name, [])
        if all(abs(time - other) >= ttl for other in own):
            own.append(time)
            kept.append(place)
    return kept


@pytest.mark.parametrize("records", [1, 3, 10_000])
def test_batch_dedup_over_batches(spark, records):
    """One id has a third of the rows, some have one, some none; ids go on from one Arrow batch to the next."""
    ship_package(spark)
    ttl, rng, before = 1000, random.Random(records), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    names = ["hot", None, "", *(f"i{n}" for n in range(40))]
    batches = [
        [(names[0] if i % 3 == 0 else rng.choice(names), T0 + rng.randrange(0, 12_000, 250)) for i in range(size)]
        for size in (120, 1, 90)
    ]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    try:
        state, found, number = spark.createDataFrame([], ACCEPTED), [], 0
        for batch in batches:
            data = [(name, "a", "k", time, Decimal(1), 0, number + i) for i, (name, time) in enumerate(batch)]
            number += len(batch)
            frame = spark.createDataFrame(data, ROW).repartition(4)
            times = [time for _, time in batch]
            near = near_times(state, min(times), max(times), ttl)
            kept = batch_dedup(frame, near, ttl)
            found += [r.source_offset for r in kept.collect()]
            state = spark.createDataFrame(next_times(kept, state, None, ttl, 0).collect(), ACCEPTED)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(found) == accepted_by_hand(batches, ttl)


def test_old_accepted_times_leave_the_state(spark):
    old = spark.createDataFrame([("a", T0 - 3 * DAY_MS), ("a", T0 - 2 * DAY_MS), ("b", T0)], ACCEPTED)
    kept = next_times(spark.createDataFrame([("c", T0 + 5)], ACCEPTED), old, T0, 2 * DAY_MS, 30_000).collect()
    assert sorted(r.event_time for r in kept) == [T0 - 2 * DAY_MS, T0, T0 + 5]


def test_dedup_query_has_no_keyed_state(spark):
    """Over restarts, as the keyed query does, but without a call to a state store for every id."""
    root, hour = fresh_path(spark, "test-dedup"), 3_600_000
    for number, hours in enumerate([(60, 0, 0), (10, 12, 60), (108, 107)]):
        data = [("t", T0 + h * hour, "txn", 0, 10 * number + i, None) for i, h in enumerate(hours)]
        columns = "transaction_id string, event_time bigint, source_topic string, source_partition int, source_offset bigint, routed_watermark bigint"
        spark.createDataFrame(data, columns).write.mode("append").parquet(f"{root}/in")
        query = start_dedup(spark.readStream.schema(columns).parquet(f"{root}/in"), f"{root}/out", f"{root}/checkpoint", once=True)
        query.awaitTermination()
        assert query.recentProgress and not any(report.stateOperators for report in query.recentProgress)
    times = sorted(r.event_time for r in Commits(spark, f"{root}/out").read("kept", ACCEPTED).collect())
    assert times == [T0, T0 + 60 * hour, T0 + 108 * hour]


def test_batch_of_the_enrichment_drops_repeats_itself(spark):
    """Its accepted times commit with the records: a replay, and a row of a later batch, find them."""
    root, cfg = fresh_path(spark, "test-enrich"), ProcessorConfig()
    rows = tables.transactions(spark, SF, repeats=tables.NEAR_REPEATS, late=False).where("source_offset < 400")
    rows = rows.withColumn("routed_watermark", F.lit(None).cast("bigint"))
    for batch_id in (0, 0, 1):
        write_batch(rows, batch_id, root, tables.blocks(spark), cfg, F.col("processing_time"))
    names = [r.transaction_id for r in Commits(spark, root).read("enriched", schemas.ENRICHED).collect()]
    assert len(names) == len(set(names)) == rows.select("transaction_id").distinct().count() < rows.count()


def routed(df):
    """Rows as the route query accepts them: the slowest row is 90 hours back, the watermark behind it."""
    names = {"source_topic": F.lit("txn"), "routed_watermark": F.col("event_time") * 0 + T0 - 4 * DAY_MS}
    return stream_dedup(df.withColumns(names))


def kept_times(spark, batches):
    times = {}
    for row in run(spark, batches, routed, rows=True):
        times.setdefault(row.transaction_id, []).append(row.event_time)
    return {name: sorted(found) for name, found in times.items()}


def contents(spark, root):
    """Rows of the three outputs; letters without the time at which an attempt wrote them."""
    sides = [spark.read.parquet(f"{root}/{side}") for side in ("valid", "dlq", "marks")]
    sides[1] = sides[1].select("dlq_id", "error_type", "error_message")
    return [sorted(map(str, side.collect())) for side in sides]


STEPS = [f"{what} {output}" for what in ("staged", "published") for output in ("valid", "dlq", "marks")]


@pytest.mark.parametrize("step", [*STEPS, "intended", "committed"])
def test_crash_at_each_step_of_a_commit(spark, step):
    """Whatever an attempt left behind, readers see each row once, and files they have stay."""
    root, cfg = fresh_path(spark, "test-route"), ProcessorConfig()
    log = tables.log_records(tables.transactions(spark, SF, repeats=[]))
    route_batch(log, 0, root, cfg)
    want = contents(spark, root)

    def dies(name):
        if name == step:
            raise RuntimeError(name)

    crashed = fresh_path(spark, "test-route")
    with pytest.raises(RuntimeError):
        route_batch(log, 0, crashed, cfg, reached=dies)
    done = Commits(spark, crashed)
    published = [side for side in ("valid", "dlq", "marks") if path_exists(spark, f"{crashed}/{side}/batch_id=0")]
    before = {side: sorted(spark.read.parquet(f"{crashed}/{side}").inputFiles()) for side in published}
    schema = spark.read.parquet(f"{root}/valid").drop("batch_id").schema
    assert done.read("valid", schema).count() == (len(want[0]) if step == "committed" else 0)
    route_batch(log, 0, crashed, cfg)
    route_batch(log, 0, crashed, cfg)
    assert contents(spark, crashed) == want and done.read("valid", schema).count() == len(want[0])
    assert all(sorted(spark.read.parquet(f"{crashed}/{side}").inputFiles()) == files for side, files in before.items())
    assert not path_exists(spark, f"{crashed}/attempts/batch_id=0") or step == "committed"


def test_of_two_attempts_one_is_taken(spark):
    """A second attempt runs while the first is between its outputs and its intent."""
    root = fresh_path(spark, "test-commits")

    def outputs(low):
        return lambda: {"a": spark.range(low, low + 5), "b": spark.range(low, low + 3)}

    def other(name):
        if name == "staged b":
            assert Commits(spark, root).commit(4, outputs(100))

    assert Commits(spark, root, other).commit(4, outputs(0))
    found = Commits(spark, root)
    schema = spark.range(1).schema
    assert sorted(r.id for r in found.read("a", schema).collect()) == list(range(100, 105))
    assert sorted(r.id for r in found.read("b", schema).collect()) == list(range(100, 103))
    assert not found.commit(4, outputs(200)) and found.read("a", schema).count() == 5


def test_missing_watermark_of_an_earlier_batch_is_an_error(spark):
    log = tables.log_records(tables.transactions(spark, SF, repeats=[]))
    with pytest.raises(FileNotFoundError):
        route_batch(log, 3, fresh_path(spark, "test-route"), ProcessorConfig())


def test_replayed_batch_changes_nothing(spark):
    root, cfg = fresh_path(spark, "test-route"), ProcessorConfig()
    log = tables.log_records(tables.transactions(spark, SF, repeats=[]))
    route_batch(log.where("offset < 5000"), 0, root, cfg)
    route_batch(log.where("offset >= 5000"), 1, root, cfg)
    first = [sorted(map(str, spark.read.parquet(f"{root}/{side}").collect())) for side in ("valid", "dlq")]
    route_batch(log.where("offset >= 5000"), 1, root, cfg)
    again = [sorted(map(str, spark.read.parquet(f"{root}/{side}").collect())) for side in ("valid", "dlq")]
    assert first == again and len(first[0]) + len(first[1]) == log.count()


def test_unfinished_batch_is_routed_the_same_way(spark):
    cfg = ProcessorConfig()
    log = tables.log_records(tables.transactions(spark, SF, repeats=[]), faults=False)
    late = []
    for _ in range(2):
        root = fresh_path(spark, "test-route")
        route_batch(log.where("offset < 5000"), 0, root, cfg)
        route_batch(log.where("offset >= 5000"), 1, root, cfg)
        late.append(sorted(r.dlq_id for r in spark.read.parquet(f"{root}/dlq").where("error_type like 'LATE%'").collect()))
    assert late[0] == late[1] and late[0]


def test_progress_rows(spark):
    root, cfg = fresh_path(spark, "test-progress"), ProcessorConfig()
    listener = ProgressLog()
    spark.streams.addListener(listener)
    tables.log_records(tables.transactions(spark, SF, repeats=[])).write.parquet(f"{root}/in")
    log = event_log.read_log_files(spark, f"{root}/in", cfg)
    query = start_route(log, f"{root}/out", f"{root}/checkpoint", cfg, once=True)
    query.awaitTermination()
    table = progress_frame(spark, query.recentProgress)
    assert table.agg(F.sum("input_rows")).first()[0] == 1000
    spark.streams.removeListener(listener)
    kafka = {
        "name": "q", "batchId": 1, "timestamp": "2026-01-01T00:00:00.000Z", "numInputRows": 5, "batchDuration": 7,
        "eventTime": {"watermark": "2025-12-31T23:58:00.000Z"},
        "sources": [{"latestOffset": '{"t":{"0":12,"1":3}}', "endOffset": '{"t":{"0":10,"1":3}}'}],
        "stateOperators": [{"numRowsTotal": 4, "memoryUsedBytes": 100}],
    }
    later = {**kafka, "batchId": 2, "timestamp": "2026-01-01T00:02:00.000Z"}
    rows = progress_frame(spark, [kafka, later])
    assert rows.first().lag == 2 and rows.first().state_bytes == 100
    age = watermark_age(rows).first()
    assert (age.age_ms, age.stalled) == (120_000, True)


class Ended:
    """What a listener gets of a run that ended."""

    def __init__(self, run, exception=None):
        self.id, self.runId, self.exception = "query", run, exception


class Report:
    def __init__(self, batch):
        body = {"name": "q", "batchId": batch, "timestamp": "2026-01-01T00:00:00.000Z", "numInputRows": batch}
        self.progress = type("Progress", (), {"json": json.dumps(body)})


def test_progress_table_forgets_nothing(spark, tmp_path):
    """Files of three rows; a second log, as of a driver started later, adds to the same table."""
    for part in (range(10), range(10, 17)):
        log = ProgressLog(f"{tmp_path}/progress", file_rows=3)
        for batch in part:
            log.onQueryProgress(Report(batch))
    log.onQueryTerminated(Ended("run", "stopped"))
    rows = log.frame(spark).collect()
    assert sorted(r.batch_id for r in rows) == [-1, *range(17)]
    assert [r.query for r in rows if r.failed] == ["query"]
    assert len(list((tmp_path / "progress").glob("[!.]*.json"))) == 7


def test_progress_table_without_reports_is_empty(spark):
    assert ProgressLog().frame(spark).count() == 0


def test_lag_by_plain_counts(spark):
    report = {"name": "files", "batchId": 0, "sources": [{"latestOffset": {"logOffset": 9}, "endOffset": {"logOffset": 4}}]}
    other = {"name": "files", "batchId": 1, "sources": [{"latestOffset": {"at": "x"}, "endOffset": {"at": "x"}}]}
    assert [r.lag for r in progress_frame(spark, [report, other]).sort("batch_id").collect()] == [5, None]


def test_state_partitions_are_a_setting(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_settings(spark, 7):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


@pytest.mark.skipif("SPARK_KAFKA_TESTS" not in os.environ, reason="the Kafka package is not installed")
def test_topic_source(spark):
    assert event_log.read_topic(spark, ProcessorConfig()).isStreaming

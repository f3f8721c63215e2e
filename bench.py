"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

import driver_queries
import driver_tables as tables
from tollgate.operators.dedup import dedup
from tollgate.operators.device import device_profile
from tollgate.operators.geo import geolocate
from tollgate.operators.velocity import velocity
from tollgate.plans.enrichment import enrich
from tollgate.plans.ingestion import ingest
from tollgate.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def bench_queries(spark):
    def rows(squeeze=1, **kwargs):
        return tables.transactions(spark, SF_DIR, squeeze, **kwargs)

    return {
        "enrich": lambda: driver_queries.base_enriched(spark, SF_DIR),
        "enrich_with_resends": lambda: driver_queries.QUERIES["enrich"](spark, SF_DIR),
        "ingest": lambda: ingest(tables.payloads(spark, SF_DIR))[0],
        "frame_decode": lambda: driver_queries.QUERIES["frame_decode"](spark, SF_DIR),
        "dedup": lambda: dedup(rows()),
        "velocity_bucket": lambda: velocity(rows(60)),
        "velocity_exact": lambda: velocity(rows(60), mode="exact"),
        "geolocate": lambda: geolocate(rows(), tables.blocks(spark)),
        "device_profile": lambda: device_profile(rows()),
        "watermark_lateness": lambda: driver_queries.QUERIES["watermark_lateness"](spark, SF_DIR),
        "reconcile": lambda: driver_queries.QUERIES["reconcile"](spark, SF_DIR),
        "latency_quantiles": lambda: driver_queries.QUERIES["latency_quantiles"](spark, SF_DIR),
        "windowed_rate": lambda: driver_queries.QUERIES["windowed_rate"](spark, SF_DIR),
    }


TIMES = 10


def enrich_many(spark):
    """The events ten times over as other ids and accounts: fixed costs weigh less."""
    rows = tables.transactions(spark, SF_DIR, repeats=tables.NEAR_REPEATS)
    copy = F.explode(F.sequence(F.lit(1), F.lit(TIMES)))
    many = rows.withColumn("_copy", copy).withColumns(
        {name: F.concat_ws("/", name, "_copy") for name in ("transaction_id", "account_id")}
        | {"source_offset": F.col("source_offset") * TIMES + F.col("_copy").cast("bigint")}
    )
    return enrich(many.drop("_copy"), tables.blocks(spark))


def main() -> None:
    spark = local_session(CPUS, int(CPUS))
    seconds = {}
    for name, build in bench_queries(spark).items():
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    start = time.perf_counter()
    enrich_many(spark).write.format("noop").mode("overwrite").save()
    seconds[f"enrich_x{TIMES}"] = round(time.perf_counter() - start, 3)
    events = tables.transactions(spark, SF_DIR, repeats=tables.NEAR_REPEATS).count()
    result = {
        "metric": "batch_enrichment",
        "value": seconds["enrich"],
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR).removeprefix("sf"),
        "events": events,
        "events_per_second": round(events / seconds["enrich"]),
        f"events_per_second_x{TIMES}": round(TIMES * events / seconds[f"enrich_x{TIMES}"]),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

"""Quantiles per group, exact and by sketches."""

import random

import numpy as np
import pytest
from support import T0
from pyspark.sql import functions as F

from tollgate.config import MINUTE_MS
from tollgate.operators import metrics

ROWS = "key string, value bigint, at bigint"


def groups(spark, items):
    return spark.createDataFrame([(k, v, T0) for k, v in items], ROWS)


def test_grouped_quantiles_interpolate(spark):
    draw = random.Random(3)
    items = [(key, draw.randint(-50, 50)) for key in "abc" for _ in range(draw.randint(1, 40))]
    items += [(None, 4), (None, 9), ("lost", None), ("one", 7), ("one", None)]
    found = metrics.grouped_quantiles(groups(spark, items), ["key"], "value", [0.0, 0.5, 0.95, 1.0])
    rows = {r.key: r for r in found.collect()}
    for key in ("a", "b", "c", None, "one"):
        values = [v for k, v in items if k == key and v is not None]
        assert rows[key]["_q"] == pytest.approx(list(np.quantile(values, [0.0, 0.5, 0.95, 1.0])))
    assert rows["one"].events == 2 and rows["lost"]["_q"] == [None] * 4


def test_quantiles_of_nothing(spark):
    empty = groups(spark, [("a", 1)]).where("false")
    assert metrics.grouped_quantiles(empty, ["key"], "value").count() == 0
    assert metrics.quantile_sketches(empty, "value", "at", ["key"]).count() == 0


def test_merged_sketches_keep_the_rank_error(spark):
    """Values of two scales over ten minutes: each window's answers against its sorted values."""
    values = (F.hash("id", F.lit(5)) % 1000) * F.when(F.col("id") % 3 == 0, 1_000_000).otherwise(1)
    rows = spark.range(60_000).select(
        F.lit("k").alias("key"), values.cast("bigint").alias("value"),
        (F.lit(T0) + F.col("id") * 10 * MINUTE_MS / 60_000).cast("bigint").alias("at"),
    )
    sketches = metrics.quantile_sketches(rows, "value", "at", ["key"])
    assert sketches.agg(F.max(F.octet_length("sketch"))).first()[0] < 12_000
    found = metrics.sliding_quantiles(sketches, ["key"], 5).collect()
    assert len(found) == 14 and max(r.n for r in found) == 30_000
    held = np.array([(r.at, r.value) for r in rows.select("at", "value").collect()])
    for r in found:
        end = r.window_end
        inside = np.sort(held[(held[:, 0] >= end - 5 * MINUTE_MS) & (held[:, 0] < end), 1])
        for q, value in zip(metrics.QUANTILES, r["values"]):
            ranks = np.searchsorted(inside, [value, value + 1]) / len(inside)
            assert ranks[0] - 2 * metrics.SKETCH_RANK_ERROR <= q <= ranks[1] + 2 * metrics.SKETCH_RANK_ERROR


def test_few_values_are_exact(spark):
    rows = groups(spark, [("k", v) for v in range(100)] + [("k", None)])
    window = metrics.sliding_quantiles(metrics.quantile_sketches(rows, "value", "at"), [], 1, [0.0, 0.5, 1.0]).first()
    assert window.n == 100 and window["values"] == [0, 49, 99]

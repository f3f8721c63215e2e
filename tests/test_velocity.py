import random
from decimal import Decimal

import pytest
from support import SKEWS, T0
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tollgate.operators.quality import invariant_violations
from tollgate.operators.velocity import minute_partials, velocity, velocity_by_currency
from tollgate.schemas import VELOCITY, VELOCITY_WINDOWS

from pyspark.sql import functions as F

M = 60_000


def brute(items, mode):
    """(account, api key, time, amount) in arrival order to feature rows by arrival index."""
    result = {}
    order = sorted(range(len(items)), key=lambda i: (items[i][2], i))
    for place, i in enumerate(order):
        account, _, time, _ = items[i]
        features = []
        for _, minutes in VELOCITY_WINDOWS:
            if mode == "bucket":
                pool = [j for j in order[: place + 1] if items[j][2] // M >= time // M - minutes]
            else:
                pool = [j for j in order if time - minutes * M < items[j][2] <= time]
            amounts = [Decimal(str(items[j][3])) for j in pool if items[j][0] == account]
            features += [len(amounts), sum(amounts)]
        result[f"t{i}"] = features
    return result


def features(df):
    return {r.transaction_id: [r[c] for c in VELOCITY.fieldNames()] for r in df.collect()}


@pytest.mark.parametrize(
    ("arrivals", "expected"),
    [
        ([(0, 49.99)], {"vel_count_1m": 1, "vel_count_24h": 1, "vel_amount_24h": Decimal("49.9900")}),
        ([(-8, 10), (-7, 10), (-6, 10), (0, 10)], {"vel_count_5m": 1, "vel_count_1h": 4, "vel_count_24h": 4}),
        ([(-2, 5), (0, 5)], {"vel_count_1m": 1, "vel_count_5m": 2}),
        ([(-1500, 1), (0, 1)], {"vel_count_24h": 1}),
        ([(-2, 1000), (0, 50)], {"vel_amount_1m": Decimal(50), "vel_amount_5m": Decimal(1050)}),
    ],
)
def test_sequences(rows, arrivals, expected):
    df = velocity(rows([("a", None, T0 + minute * M, amount) for minute, amount in arrivals]))
    last = df.orderBy(F.desc("source_offset")).first().asDict()
    assert {name: last[name] for name in expected} == expected


@pytest.mark.parametrize("mode", ["bucket", "exact"])
@pytest.mark.parametrize("skew", SKEWS)
def test_agrees_with_brute_force(rows, mode, skew):
    random.seed(3)
    spots = [0, 1, 59_999, 60_000, 5 * M, 60 * M, 1440 * M]
    items = [
        (random.choice(["a", "a", "b"]), None, T0 + random.choice(spots) + random.choice([0, 0, 7, 61_000]), random.randint(1, 999) / 100)
        for _ in range(150)
    ]
    assert features(velocity(rows(items), skew, mode)) == brute(items, mode)


def test_bucket_and_exact_differ_at_the_edge(rows):
    df = rows([("a", None, T0, 1), ("a", None, T0 + M, 1)])
    assert features(velocity(df))["t1"][0] == 2
    assert features(velocity(df, mode="exact"))["t1"][0] == 1


def test_currencies_are_kept_apart(rows):
    df = rows([("a", None, T0, 1), ("a", None, T0 + 1, 2), ("a", None, T0 + 2, 4)]).withColumn(
        "currency", F.when(F.col("source_offset") == 1, "EUR").otherwise("USD")
    )
    found = features(velocity_by_currency(df))
    assert [found[f"t{i}"][1] for i in range(3)] == [Decimal(1), Decimal(2), Decimal(5)]


def test_minute_partials(rows):
    found = minute_partials(rows([("a", None, T0, 1), ("a", None, T0 + 5, 2), ("a", None, T0 + M, 4)]))
    assert sorted((r.bucket - T0 // M, r.cnt, r.amount_sum) for r in found.collect()) == [
        (0, 2, Decimal(3)), (1, 1, Decimal(4)),
    ]


def test_unknown_mode(rows):
    with pytest.raises(ValueError):
        velocity(rows([("a", None, T0, 1)]), mode="tumbling")


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(-1440 * M, 0), st.integers(1, 1_000_000)), min_size=1, max_size=60
    )
)
def test_invariants_hold(spark, rows, draws):
    items = [("a", "k", T0 + offset, cents / 100) for offset, cents in sorted(draws)]
    df = velocity(rows(items)).withColumns(
        {"device_first_seen": F.lit(None).cast("long"), "device_txn_count": F.lit(None).cast("int")}
    )
    assert invariant_violations(df).count() == 0

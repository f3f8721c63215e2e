"""Shards of near equal bytes by histogram sort: splitters from exact counts, then one exchange."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import Store, longs

LOW, HIGH = -(2**63), 2**63
#: Probes a round sets in each open interval.
PROBES = 64
#: Rows of a range, about: the unit that one task sorts.
RANGE_ROWS = 200_000


def bytes_of(text: Column) -> Column:
    """UTF-8 bytes and 16 for the record."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


@dataclass(frozen=True)
class Splitter:
    """Rows whose (first, second) key is smaller lie below; bytes and rows are their exact sums."""

    first: int
    second: int
    bytes: int
    rows: int


def below(keys: DataFrame, points: list[int], column: str) -> dict[int, tuple[int, int]]:
    """For each ascending point the exact bytes and rows of all keys below it; tasks pre-add their rows."""
    marks = np.array(points, np.int64)

    def count(batches):
        size, rows = np.zeros(len(marks) + 1, np.int64), np.zeros(len(marks) + 1, np.int64)
        for batch in batches:
            part = np.searchsorted(marks, batch.column(0).to_numpy(), side="right")
            np.add.at(size, part, batch.column(1).to_numpy())
            rows += np.bincount(part, minlength=len(rows))
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(size[used]), pa.array(rows[used])], names=["part", "bytes", "rows"]
        )

    counted = keys.select(column, "size").mapInArrow(count, longs("part", "bytes", "rows"))
    counted = counted.groupBy("part").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    parts = {row["part"]: (row["bytes"], row["rows"]) for row in counted.collect()}
    sums, size, rows = {}, 0, 0
    for i, point in enumerate(points):
        more = parts.get(i, (0, 0))
        size, rows = size + more[0], rows + more[1]
        sums[point] = (size, rows)
    return sums


def spread(low: int, high: int, probes: int) -> list[int]:
    step = max(1, (high - low) // (probes + 1))
    return [point for point in range(low + step, high, step)][:probes]


def splitters(keys: DataFrame, goals: list[float], tolerance: float, probes: int = PROBES) -> list[Splitter]:
    """Boundaries of the (first, second) key space with about the goals' bytes below them.

    Each round sets probes inside the interval of every open goal, counts the exact bytes below all
    of them in one pass, and keeps the closest. A goal is met within the tolerance, or when one row
    is left around it. When its interval is a single first key with more rows, the same search runs over the second keys of the rows with
    that first key. The driver holds probes and sums only, however many rows there are.
    """
    found: dict[float, Splitter] = {}
    total = keys.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    known = {LOW: (0, 0), HIGH: (total["bytes"] or 0, total["rows"])}
    hot: dict[int, list[float]] = {}
    open_goals = list(goals)
    while open_goals:
        points = sorted(known)
        sums = [known[point][0] for point in points]
        wanted, waiting = set(), []
        for goal in open_goals:
            at = min(max(bisect_right(sums, goal) - 1, 0), len(points) - 2)
            low, high = points[at], points[at + 1]
            best = min((low, high), key=lambda point: abs(known[point][0] - goal))
            met = abs(known[best][0] - goal) <= tolerance or known[high][1] - known[low][1] <= 1
            if met:
                best = best if best < HIGH else low
                found[goal] = Splitter(best, LOW, *known[best])
            elif high - low <= 1:
                hot.setdefault(low, []).append(goal)
            else:
                wanted.update(spread(low, high, probes))
                waiting.append(goal)
        open_goals = waiting
        if wanted:
            new = below(keys, sorted(wanted), "first")
            known.update(new)
    for first, own in hot.items():
        base_bytes, base_rows = known[first]
        rows = keys.where(F.col("first") == F.lit(first))
        inside = splitters_inside(rows, [goal - base_bytes for goal in own], tolerance, probes)
        for goal, (second, size, count) in zip(own, inside, strict=True):
            found[goal] = Splitter(first, second, base_bytes + size, base_rows + count)
    return [found[goal] for goal in goals]


def splitters_inside(rows: DataFrame, goals: list[float], tolerance: float, probes: int) -> list[tuple[int, int, int]]:
    """The same search over second keys; it ends at single keys, whichever side is closer."""
    total = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    known = {LOW: (0, 0), HIGH: (total["bytes"] or 0, total["rows"])}
    found: dict[float, int] = {}
    while len(found) < len(set(goals)):
        points = sorted(known)
        sums = [known[point][0] for point in points]
        wanted = set()
        for goal in set(goals) - set(found):
            at = min(max(bisect_right(sums, goal) - 1, 0), len(points) - 2)
            low, high = points[at], points[at + 1]
            best = min((low, high), key=lambda point: abs(known[point][0] - goal))
            met = abs(known[best][0] - goal) <= tolerance or known[high][1] - known[low][1] <= 1
            if met or high - low <= 1:
                found[goal] = best
            else:
                wanted.update(spread(low, high, probes))
        if wanted:
            known.update(below(rows, sorted(wanted), "second"))
    return [(min(found[goal], HIGH - 1), *known[found[goal]]) for goal in goals]


def shard(
    docs: DataFrame,
    shards: int = 40,
    doc_id: str = "doc_id",
    text: str = "text",
    tolerance: float = 0.001,
    probes: int = PROBES,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Put documents into shards of near equal bytes.

    Gives doc_id, text, size, shard and slot (0 to n - 1 in each shard). The sort key is the text's
    hash, then the id, so equal texts lie next to one another and a group of copies larger than a
    shard is divided by ids. Shards end at splitters within tolerance of a shard's even share, or at
    the nearest row. Each shard consists of ranges of about range_rows rows, found by the same
    search; rows are exchanged once, by range, and a row's slot is the exact count of rows below its
    range plus its place there.

    A null text has no bytes; a null id sorts as the smallest. Repeated rows are rows of their own;
    those that share text and id cannot be divided. Fewer rows than shards leave shards empty; no
    rows give no rows. Other columns are not read.
    """
    store = Store(docs.sparkSession, "sharding")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        bytes_of(F.col(text)).alias("size"),
        F.xxhash64(F.col(text)).alias("first"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LOW)).alias("second"),
    )
    keys = store.keep(rows.select("first", "second", "size"), "keys")
    total = keys.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    size, count = total["bytes"] or 0, total["rows"]
    per_shard = max(1, -(-count // (shards * range_rows)))
    parts = shards * per_shard
    goals = [size * i / parts for i in range(1, parts)]
    ends = splitters(keys, goals, tolerance * size / shards, probes)
    store.drop(keys)
    ends.sort(key=lambda end: (end.first, end.second))
    starts = [Splitter(LOW, LOW, 0, 0), *ends]
    bases = [start.rows - starts[i - i % per_shard].rows for i, start in enumerate(starts)]
    place = placer([(end.first, end.second) for end in ends], bases)
    placed = rows.withColumn("place", place("first", "second"))
    placed = placed.select("*", F.col("place.range").alias("range"), F.col("place.base").alias("base"))
    placed = placed.withColumn("shard", F.floor(F.col("range") / per_shard).cast("int"))
    order = Window.partitionBy("range").orderBy("first", "second", "size")
    slot = F.col("base") + F.row_number().over(order) - 1
    return placed.select("doc_id", "text", "size", "shard", slot.cast("long").alias("slot"))


def placer(points: list[tuple[int, int]], bases: list[int]):
    """A key's range, i.e. how many of the ascending points are at or below it, and the range's base."""
    firsts = np.array([point[0] for point in points], np.int64)
    seconds = np.array([point[1] for point in points], np.int64)
    base_of = np.array(bases, np.int64)

    @F.pandas_udf("range int, base long")
    def place(first: pd.Series, second: pd.Series) -> pd.DataFrame:
        key, sub = first.to_numpy(), second.to_numpy()
        begin, end = (np.searchsorted(firsts, key, side=side) for side in ("left", "right"))
        part = begin.copy()
        for at in np.unique(begin[end > begin]):
            same = (begin == at) & (end > begin)
            inside = seconds[at : end[same][0]]
            part[same] += np.searchsorted(inside, sub[same], side="right")
        return pd.DataFrame({"range": part.astype(np.int32), "base": base_of[part]})

    return place

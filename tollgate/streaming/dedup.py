"""Deduplication of a stream: the accepted times of earlier batches as a table, rows of one batch in arrival order.

The state is a table (transaction id, event time) in pieces, as that of velocity is: each batch adds
one, and every FAN pieces become one that leaves out times which no later row can be near to. It
commits with the rows it was worked out for. A batch sorts its rows by id and runs through them once, so
the work per row is that of a sort and no call to a state store is made for an id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tollgate.config import MINUTE_MS, ProcessorConfig
from tollgate.schemas import ARRIVAL
from tollgate.session import ship_package
from tollgate.streaming.commits import Commits
from tollgate.streaming.velocity import joined_pieces, live_pieces, read_pieces

#: How far files of one routed batch may trail the next one's; times are remembered so much longer.
CLOCK_SLACK_MS = 10 * MINUTE_MS
ACCEPTED = T.StructType(
    [T.StructField("transaction_id", T.StringType()), T.StructField("event_time", T.LongType())]
)


def _group_starts(ids: pa.Array) -> np.ndarray:
    """Places where another id begins; null is an id of its own."""
    if len(ids) < 2:
        return np.zeros(len(ids), np.int64)
    here, last = ids[1:], ids[:-1]
    other = pc.or_(pc.fill_null(pc.not_equal(here, last), False), pc.xor(pc.is_null(here), pc.is_null(last)))
    return np.concatenate(([0], np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1))


def far_apart(ttl_ms: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows that are the ttl or more from every accepted time of their id, earlier or later.

    Elements are sorted by id; the accepted times from before come first in it (kind 0), then its rows
    in arrival order. Accepted times lie the ttl apart at least, so a slot of the ttl's length holds
    one at most, and a row need only be compared with those of its own slot and of the two beside it.
    """

    def run(batches):
        last, accepted = False, {}  # no id yet; a null one is None
        for batch in batches:
            if not len(batch):
                continue
            ids = batch.column(0)
            kinds = batch.column(1).to_numpy(zero_copy_only=False)
            times = batch.column(2).to_numpy(zero_copy_only=False)
            starts = _group_starts(ids)
            ends = np.append(starts[1:], len(ids))
            keep = kinds == 1
            # an id with one element stands alone, unless a batch may cut it off from others
            looked = ends - starts > 1
            looked[[0, -1]] = True
            for start, end in zip(starts[looked].tolist(), ends[looked].tolist(), strict=True):
                if start > 0 or ids[0].as_py() != last:
                    accepted = {}
                for place, new, time in zip(
                    range(start, end), keep[start:end].tolist(), times[start:end].tolist(), strict=True
                ):
                    slot = time // ttl_ms
                    if new and any(
                        abs(time - accepted.get(beside, time - ttl_ms)) < ttl_ms for beside in (slot - 1, slot, slot + 1)
                    ):
                        keep[place] = False
                    else:
                        accepted[slot] = time
            last = ids[-1].as_py()
            yield pa.RecordBatch.from_arrays([batch.column(3)], names=["_row"]).filter(pa.array(keep))

    return run


def batch_dedup(rows: DataFrame, state: DataFrame, ttl_ms: int) -> DataFrame:
    """Rows of one batch, in arrival order after all of state, without those near an accepted time of their id."""
    order = [c for c in ("source_topic", *ARRIVAL) if c in rows.columns]
    new = rows.select(
        "transaction_id", F.lit(1).alias("_kind"), "event_time", F.struct(*rows.columns).alias("_row")
    )
    old = state.select(
        "transaction_id", F.lit(0).alias("_kind"), "event_time", F.lit(None).cast(rows.schema).alias("_row")
    )
    elements = new.unionByName(old).repartition("transaction_id")
    elements = elements.sortWithinPartitions("transaction_id", "_kind", *(F.col(f"_row.{c}") for c in order))
    schema = T.StructType([T.StructField("_row", rows.schema)])
    return elements.mapInArrow(far_apart(ttl_ms), schema).select("_row.*")


def near_times(state: DataFrame, earliest: int | None, latest: int | None, ttl_ms: int) -> DataFrame:
    """The accepted times that a row between two times can be near to."""
    if earliest is None:
        return state
    return state.where((F.col("event_time") > earliest - ttl_ms) & (F.col("event_time") < latest + ttl_ms))


def next_times(
    kept: DataFrame, replaced: DataFrame, clock: int | None, ttl_ms: int, lateness_ms: int
) -> DataFrame:
    """The piece of a batch: the times of the rows it kept with those of the pieces it replaces.

    clock is the watermark under which the batch's rows were accepted: no later row lies more than the
    lateness behind it.
    """
    both = kept.select(*ACCEPTED.fieldNames()).unionByName(replaced)
    if clock is not None:
        both = both.where(F.col("event_time") > clock - lateness_ms - CLOCK_SLACK_MS - ttl_ms)
    return both.sortWithinPartitions("event_time")  # so that readers skip what is too far


def dedup_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    cfg: ProcessorConfig,
    reached: Callable[[str], None] | None = None,
) -> None:
    """The rows of one micro-batch that are no repeats, and the accepted times, committed together, once."""
    spark, held = batch.sparkSession, []
    commits = Commits(spark, path, reached)

    def outputs() -> dict[str, DataFrame]:
        if batch_id > 0 and not commits.done(batch_id - 1):
            raise FileNotFoundError(f"no commit of batch {batch_id - 1} under {path}")
        clock, earliest, latest = batch.agg(
            F.max("routed_watermark"), F.min("event_time"), F.max("event_time")
        ).first()
        state, joined = (
            read_pieces(spark, f"{path}/accepted", pieces, ACCEPTED)
            for pieces in (live_pieces(batch_id), joined_pieces(batch_id))
        )
        kept = batch_dedup(batch, near_times(state, earliest, latest, cfg.dedup_ttl_ms), cfg.dedup_ttl_ms).persist()
        held.append(kept)
        return {"kept": kept, "accepted": next_times(kept, joined, clock, cfg.dedup_ttl_ms, cfg.lateness_ms)}

    try:
        commits.commit(batch_id, outputs)
        for replaced in joined_pieces(batch_id):
            commits.remove("accepted", replaced)
    finally:
        for df in held:
            df.unpersist()


def start_dedup(
    rows: DataFrame, path: str, checkpoint: str, cfg: ProcessorConfig | None = None, once: bool = False
) -> StreamingQuery:
    """Start writing the rows of a stream of valid rows that are no repeats into ``path``/kept."""
    cfg = cfg or ProcessorConfig()
    ship_package(rows.sparkSession)
    writer = (
        rows.writeStream.queryName("dedup")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: dedup_batch(batch, batch_id, path, cfg))
    )
    writer = (
        writer.trigger(availableNow=True)
        if once
        else writer.trigger(processingTime=f"{cfg.checkpoint_interval_ms} milliseconds")
    )
    return writer.start()

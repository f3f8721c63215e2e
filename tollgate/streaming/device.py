"""Device history of a stream: the sessions of earlier batches as a table, shared with the batch operator.

A segment is first time, last time and count of a run of one device's events. Segments are joined by
minimum, maximum and sum wherever no gap parts them, whatever the order, so the state is a table of them
in pieces, as that of velocity is: each batch adds one, and every FAN pieces become one in which a
session is one segment and sessions that no later row can reach are gone. The state of a batch commits
with its records; no key is bound to one task, and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tollgate.config import SkewConfig
from tollgate.operators.device import IDLE_MS, SEGMENT, device_profile, segments, sessions

SEGMENTS = T.StructType(
    [T.StructField(SEGMENT[0], T.StringType()), *(T.StructField(name, T.LongType()) for name in SEGMENT[1:])]
)


def batch_device(
    rows: DataFrame,
    state: DataFrame,
    skew: SkewConfig | None = None,
    idle_ms: int = IDLE_MS,
    base: DataFrame | None = None,
) -> DataFrame:
    """Adds the device columns to the rows of one batch, in order of event time after all of state."""
    devices = (rows if base is None else base).select("api_key_id").distinct()
    held = sessions(state.join(devices, "api_key_id", "left_semi"), idle_ms)
    return device_profile(rows, skew, idle_ms, base=base, held=held)


def next_segments(
    rows: DataFrame,
    replaced: DataFrame | None,
    others: DataFrame,
    clock: int | None,
    lateness_ms: int,
    idle_ms: int = IDLE_MS,
) -> DataFrame:
    """The piece of a batch: its own segments, joined with those of the pieces it replaces, if any.

    clock is the watermark under which the batch's rows were accepted. No later row lies more than the
    lateness behind it, so none reaches a session that ended idle_ms before that. ``others`` are the
    pieces that stay: what they hold may be part of a session too.
    """
    own = segments(rows, idle_ms)
    if replaced is None:
        return own
    since = None if clock is None else clock - lateness_ms - idle_ms
    return sessions(own.unionByName(replaced), idle_ms, others, since)

"""Keyed state: accepted times per transaction.

The rows of one key in one micro-batch are handled together in arrival order, so state is read
and written once per key and batch. The batch size options of the source bound their number.
"""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

_SLOT = T.StructType([T.StructField("slot", T.LongType())])
_ACCEPTED = T.StructType([T.StructField("event_time", T.LongType())])


class DedupProcessor(StatefulProcessor):
    """Drops a row less than the ttl from an accepted row of its id, earlier or later.

    Accepted times lie the ttl apart at least, so a slot of the ttl's length holds one at most, and
    a row need only be compared with those of its own slot and of the two beside it.

    The event-time clock of the query is the routed watermark, so no row that can still come lies
    more than the allowed lateness behind it: until then a time is remembered. The one timer of an
    id is that of its earliest time.
    """

    def __init__(self, ttl_ms: int, lateness_ms: int) -> None:
        self._ttl_ms, self._lateness_ms = ttl_ms, lateness_ms

    def init(self, handle) -> None:
        self._handle = handle
        self._accepted = handle.getMapState("accepted", _SLOT, _ACCEPTED)

    def handleInputRows(self, key, rows, timerValues):
        accepted = {slot[0]: time[0] for slot, time in self._accepted.iterator()}
        first = min(accepted.values(), default=None)
        for row in sorted(rows, key=lambda r: (r.source_topic, r.source_partition, r.source_offset)):
            slot = row.event_time // self._ttl_ms
            near = (accepted.get(beside) for beside in (slot - 1, slot, slot + 1))
            if all(time is None or abs(row.event_time - time) >= self._ttl_ms for time in near):
                accepted[slot] = row.event_time
                self._accepted.updateValue((slot,), (row.event_time,))
                yield row
        self._move_timer(first, min(accepted.values()))

    def _move_timer(self, old, new) -> None:
        if old != new:
            if old is not None:
                self._handle.deleteTimer(self._end(old))
            if new is not None:
                self._handle.registerTimer(self._end(new))

    def _end(self, time: int) -> int:
        return time + self._ttl_ms + self._lateness_ms

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = expiredTimerInfo.getExpiryTimeInMs()
        accepted = {slot[0]: time[0] for slot, time in self._accepted.iterator()}
        for slot, time in accepted.items():
            if self._end(time) <= now:
                self._accepted.removeKey((slot,))
        left = [time for time in accepted.values() if self._end(time) > now]
        self._move_timer(None, min(left, default=None))
        return iter([])

    def close(self) -> None:
        pass

"""Progress of running queries as rows."""

from __future__ import annotations

import json
import threading
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tollgate.session import fresh_path, path_exists, replace_file

_PROGRESS = (
    "query string, batch_id bigint, recorded_at bigint, input_rows bigint, batch_ms bigint, "
    "watermark bigint, lag bigint, state_rows bigint, state_bytes bigint, failed boolean"
)


def _epoch_ms(text: str | None) -> int | None:
    if not text:
        return None
    return int(datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp() * 1000)


def _offset_sum(value) -> int | None:
    """Sum of per-topic, per-partition offsets, or of plain counts by name; null for other sources."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return None
    if not isinstance(value, dict):
        return None
    parts = [n for part in value.values() for n in (part.values() if isinstance(part, dict) else [part])]
    return sum(parts) if all(isinstance(n, int) for n in parts) else None


def progress_row(progress: dict) -> tuple:
    """One row of the progress table from a progress report."""
    lags = []
    for source in progress.get("sources", []):
        ends = [_offset_sum(source.get(name)) for name in ("latestOffset", "endOffset")]
        if None not in ends:
            lags.append(ends[0] - ends[1])
    states = progress.get("stateOperators", [])
    return (
        progress.get("name"),
        progress["batchId"],
        _epoch_ms(progress.get("timestamp")),
        progress.get("numInputRows", 0),
        progress.get("batchDuration"),
        _epoch_ms(progress.get("eventTime", {}).get("watermark")),
        sum(lags) if lags else None,
        sum(s.get("numRowsTotal", 0) for s in states),
        sum(s.get("memoryUsedBytes", 0) for s in states),
        False,
    )


_NAMES = [column.split()[0] for column in _PROGRESS.split(", ")]


class ProgressLog(StreamingQueryListener):
    """Keeps every report and failure in a table of the shared folder; ``frame`` reads it.

    Each report rewrites the log's newest file by a rename, until that holds ``file_rows`` rows and
    the next one starts. So nothing is forgotten, memory holds one file, and a stopped driver loses no
    report that reached it. A write that fails is made good by the next one. Several drivers may
    use one ``path``: each log has files of its own. Without a path there is a fresh folder.
    """

    def __init__(self, path: str | None = None, file_rows: int = 256) -> None:
        self._path, self._file_rows = path, file_rows
        self._log, self._number, self._rows = uuid.uuid4().hex, 0, []
        self._changed, self._ended = threading.Condition(), set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._append(progress_row(json.loads(event.progress.json)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            now = int(datetime.now().timestamp() * 1000)
            self._append((str(event.id), -1, now, 0, None, None, None, 0, 0, True))
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Wait until the last report of an ended run is in the table; reports arrive after the run."""
        run = str(query.runId)
        with self._changed:
            return self._changed.wait_for(lambda: run in self._ended, seconds)

    def frame(self, spark: SparkSession) -> DataFrame:
        """All rows of the table, those of earlier drivers included."""
        path = self._folder(spark)
        if not path_exists(spark, path):
            return spark.createDataFrame([], _PROGRESS)
        return spark.read.schema(_PROGRESS).json(path)

    def _folder(self, spark: SparkSession) -> str:
        self._path = self._path or fresh_path(spark, "progress")
        return self._path

    def _append(self, row: tuple) -> None:
        with self._changed:
            if len(self._rows) >= self._file_rows:
                self._rows, self._number = [], self._number + 1
            self._rows.append(row)
            spark = SparkSession.active()
            text = "\n".join(json.dumps(dict(zip(_NAMES, kept))) for kept in self._rows)
            replace_file(spark, f"{self._folder(spark)}/{self._log}-{self._number:08d}.json", text)


def progress_frame(spark: SparkSession, reports: list[dict]) -> DataFrame:
    """Progress table of ``query.recentProgress``."""
    rows = [progress_row(r if isinstance(r, dict) else json.loads(r.json)) for r in reports]
    return spark.createDataFrame(rows, _PROGRESS)


def watermark_age(progress: DataFrame, limit_ms: int = 60_000) -> DataFrame:
    """Per query: how long ago the watermark last moved, as of its last report."""
    moved = progress.groupBy("query", "watermark").agg(F.min("recorded_at").alias("_since"))
    latest = progress.groupBy("query").agg(
        F.max("recorded_at").alias("_now"), F.max("watermark").alias("watermark")
    )
    return latest.join(moved, ["query", "watermark"]).select(
        "query",
        "watermark",
        (F.col("_now") - F.col("_since")).alias("age_ms"),
        (F.col("_now") - F.col("_since") > limit_ms).alias("stalled"),
    )

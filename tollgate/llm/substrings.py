"""Repeated substrings by level-wise doubling: only windows repeated at one length reach the next."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.anchors import Passages, flatten, keyed, repeats
from tollgate.llm.common import Store, text_steps
from tollgate.llm.words import words_of

WINDOW = 20
FIRST = -(2**63)


def pairs(hashes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(ids)], names=["hash", "doc_id"])


def id_numbers(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False)


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Remove each word inside a window of `window` words that also starts earlier.

    Earlier is a smaller doc_id, or the same document and a smaller start; windows are judged on the
    input. Gives doc_id, kept (the other words, joined by one space), n_words, n_removed and
    kept_sha256 (lowercase hex of kept in UTF-8).

    Level by level: at half the window, the runs of words that texts choose by content (every window
    holds one, at the same place wherever it stands) are counted over all documents. Windows of full
    length are formed around the repeated ones alone, and the smallest document of each window is
    found. So a text that repeats nothing sends one row for about six words and leaves. Counting is
    by minimum and maximum of the document per hash, added up in the tasks first, so a passage that
    a third of all documents share costs one row per task; the join that marks documents with their
    repeated runs is a sort or hash join, whose large partitions Spark divides. What returns to a
    document is bounded by its own length.

    Words are compared by 64-bit hashes. A null text has no words. A null id counts as the smallest;
    rows that share an id are not earlier than each other. Other columns are not read; no rows give
    no rows.
    """
    store = Store(docs.sparkSession, "substrings")
    anchor = max(1, window // 2)
    number = F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST)).alias("doc_id")
    rows = docs.select(number, F.col(text).alias("text"))

    def short_runs(batches):
        for part, data, borders in text_steps(batches, "text"):
            found = Passages(words_of(data, borders), window, anchor)
            _, first = np.unique(found.keys, return_index=True)
            yield pairs(found.hashes[first], id_numbers(part)[found.rows[first]])

    runs = store.keep(rows.mapInArrow(short_runs, "hash long, doc_id long"), "runs")
    span = runs.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    repeated = span.where("low <> high").select("hash")
    marks = runs.join(repeated.hint("shuffle_hash"), "hash").groupBy("doc_id").agg(F.collect_list("hash").alias("marks"))
    marks = store.keep(marks, "marks")
    store.drop(runs)

    def whole_windows(batches):
        for part, data, borders in text_steps(batches, "text"):
            found = Passages(words_of(data, borders), window, anchor)
            marked = np.isin(found.keys, keyed(*flatten(part.column(2))))
            hashes, of, keys = found.windows(found.starts(marked))
            _, first = np.unique(keys, return_index=True)
            yield pairs(hashes[first], id_numbers(part)[of[first]])

    windows = rows.join(marks, "doc_id").mapInArrow(whole_windows, "hash long, doc_id long")
    firsts = windows.groupBy("hash").agg(F.min("doc_id").alias("doc_id"))
    firsts = store.keep(firsts.groupBy("doc_id").agg(F.collect_list("hash").alias("firsts")), "firsts")

    def remove(batches):
        for part, data, borders in text_steps(batches, "text"):
            words = words_of(data, borders)
            found = Passages(words, window, anchor)
            marked = np.isin(found.keys, keyed(*flatten(part.column(2))))
            among = found.starts(marked)
            _, _, keys = found.windows(among)
            later = among[~np.isin(keys, keyed(*flatten(part.column(3))))]
            # repeats inside one document need no other document's word
            own = found.starts(marked | repeats(found.keys))
            _, _, keys = found.windows(own)
            _, first = np.unique(keys, return_index=True)
            again = np.delete(own, first)
            gone = found.cover(np.union1d(later, again))
            yield kept_words(part.column(0), data, words, gone)

    schema = "doc_id long, kept string, n_words long, n_removed long, kept_sha256 string"
    result = rows.join(marks, "doc_id", "left").join(firsts, "doc_id", "left").mapInArrow(remove, schema)
    return result.withColumn("doc_id", F.when(F.col("doc_id") != FIRST, F.col("doc_id")))


def kept_words(ids: pa.Array, data: np.ndarray, words, gone: np.ndarray) -> pa.RecordBatch:
    """The texts without the words that are gone, one space between words, and their digests."""
    size = len(words.borders) - 1
    removed = np.concatenate(([0], np.cumsum(gone)))[words.borders]
    removed, counts = np.diff(removed), np.diff(words.borders)
    raw, kept = data.tobytes(), []
    starts, ends = words.starts.tolist(), words.ends.tolist()
    for row in range(size):
        a, b = int(words.borders[row]), int(words.borders[row + 1])
        if removed[row]:
            own = [raw[starts[i] : ends[i]] for i in (np.flatnonzero(~gone[a:b]) + a).tolist()]
            kept.append(b" ".join(own))
        else:
            kept.append(b" ".join(raw[starts[a] : ends[b - 1]].split()) if b > a else b"")
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(kept, pa.binary()).cast(pa.string()),
            pa.array(counts),
            pa.array(removed),
            pa.array([hashlib.sha256(one).hexdigest() for one in kept], pa.string()),
        ],
        names=["doc_id", "kept", "n_words", "n_removed", "kept_sha256"],
    )

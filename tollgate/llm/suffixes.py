"""Repeated passages by sparse suffix arrays: sort, compare neighbours, extend."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.anchors import Passages, flatten, keyed
from tollgate.llm.common import Store, text_steps
from tollgate.llm.words import run_hashes, words_of

#: Shortest passage that counts, and the words by which suffixes are sorted.
PASSAGE = 50
PREFIX = 10
FIRST = -(2**63)

SORTED = "hash long, doc_id long, place long"
#: again: the row before it has the same hash, and another document or place. edge 1 and 2 mark the first and
#: last row of a task, which do not see the row before or after them.
COMPARED = f"{SORTED}, again boolean, twin boolean, edge int, task int"


def triples(hashes: np.ndarray, ids: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(hashes.view(np.int64)), pa.array(ids), pa.array(places)]
    return pa.RecordBatch.from_arrays(columns, names=["hash", "doc_id", "place"])


def compare(batches):
    """Compare each row of a sorted task with its neighbours; rows without an equal one are dropped."""
    task, held, first = TaskContext.get().partitionId(), None, True
    for batch in batches:
        rows = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
        if held is not None:
            rows = [np.concatenate(pair) for pair in zip(held, rows, strict=True)]
        elif not len(rows[0]):
            continue
        yield from judged(rows, task, first, False)
        # the last two rows stay: the last has not met its successor, the other shows what it equals
        first, held = False, [column[-2:] for column in rows]
        if len(rows[0]) == 1:
            first = True
    if held is not None:
        yield from judged(held, task, first, True)


def judged(rows: list[np.ndarray], task: int, first: bool, last: bool):
    """Verdicts on all rows but the last, which the next call judges, and but those judged before."""
    hashes = rows[0]
    equal = hashes[1:] == hashes[:-1]
    moved = (rows[1][1:] != rows[1][:-1]) | (rows[2][1:] != rows[2][:-1])
    again = np.concatenate(([False], equal & moved))
    twin = np.concatenate(([False], equal)) | np.concatenate((equal, [False]))
    edge = np.zeros(len(hashes), np.int32)
    if first:
        edge[0] = 1
    begin, end = (0 if first else 1), len(hashes) if last else len(hashes) - 1
    if last:
        edge[-1] |= 2
    chosen = np.flatnonzero(twin | (edge > 0))
    chosen = chosen[(chosen >= begin) & (chosen < end)]
    columns = [pa.array(column[chosen]) for column in (*rows, again, twin, edge)]
    tasks = pa.array(np.full(len(chosen), task, np.int32))
    yield pa.RecordBatch.from_arrays(
        [*columns, tasks], names=["hash", "doc_id", "place", "again", "twin", "edge", "task"]
    )


def neighbours(store: Store, rows: DataFrame) -> DataFrame:
    """Rows (hash, doc_id, place) that equal another row's hash, and whether an earlier row has it.

    Rows are dealt by ranges of (hash, doc_id, place), so one frequent hash takes as many tasks as it
    needs. The driver joins the tasks' ends: two rows a task.
    """
    order = ["hash", "doc_id", "place"]
    partitions = int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    compared = store.keep(ranged.mapInArrow(compare, COMPARED), "compared")
    ends = compared.where("edge > 0").orderBy("task", "edge").collect()
    again, twin = set(), set()
    for before, after in zip(ends, ends[1:], strict=False):
        if before["task"] != after["task"] and before["hash"] == after["hash"]:
            if before[1:3] != after[1:3]:
                again.add(after[:3])
            twin.update((before[:3], after[:3]))
    joined = [(*row, row in again, True) for row in sorted(twin)]
    more = store.spark.createDataFrame(joined, f"{SORTED}, again boolean, twin boolean")
    found = compared.where("twin").select(*order, "again").unionByName(more.select(*order, "again"))
    return found


def repeated_passages(
    docs: DataFrame,
    make: Callable,
    schema: str,
    doc_id: str = "doc_id",
    text: str = "text",
    columns: tuple[str, ...] = (),
    passage: int = PASSAGE,
    prefix: int = PREFIX,
) -> DataFrame:
    """Find passages of at least `passage` words that also start earlier; make decides what comes out.

    Suffixes start at minimisers of `prefix` words, chosen so that every passage holds one at the
    same place wherever it stands: about one for twenty words. They are sorted by their hashed
    prefix, then document and place, and each is compared with its neighbours; one that equals none
    leaves. The others are extended left and right to all windows of `passage` words around them,
    which are sorted and compared in the same way: a window equal to its predecessor starts earlier
    elsewhere. Windows that overlap make up a passage, so a match is as long as its texts agree.

    make(batch, data, words, covered) gets the input rows (doc_id, text, then `columns`), their bytes
    and words, and for each word whether such a window covers it, and returns a batch of schema.
    """
    store = Store(docs.sparkSession, "suffixes")
    number = F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST)).alias("_doc")
    rows = docs.select(F.col(doc_id), F.col(text).alias("text"), *columns, number)
    texts = rows.select(F.col("_doc").alias("doc_id"), "text")

    def suffixes(batches):
        for part, data, borders in text_steps(batches, "text"):
            found = Passages(words_of(data, borders), passage, prefix)
            ids = part.column(0).to_numpy()
            yield triples(found.hashes, ids[found.rows], found.places - found.words.borders[found.rows])

    sparse = store.keep(texts.mapInArrow(suffixes, SORTED), "suffixes")
    matched = neighbours(store, sparse)
    marks = matched.groupBy("doc_id").agg(F.collect_set("hash").alias("marks"))
    marks = store.keep(marks, "marks", within=(sparse,))
    store.drop(sparse)

    def extended(batches):
        for part, data, borders in text_steps(batches, "text"):
            words = words_of(data, borders)
            found = Passages(words, passage, prefix)
            marked = np.isin(found.keys, keyed(*flatten(part.column(2))))
            starts = found.starts(marked)
            hashes, of, _ = found.windows(starts)
            yield triples(hashes, part.column(0).to_numpy()[of], starts - words.borders[of])

    windows = store.keep(texts.join(marks, "doc_id").mapInArrow(extended, SORTED), "windows")
    later = neighbours(store, windows).where("again")
    later = later.groupBy(F.col("doc_id").alias("_doc")).agg(
        F.collect_list("place").alias("_starts"), F.collect_list("hash").alias("_hashes")
    )
    later = store.keep(later, "later", within=(windows,))
    store.drop(windows, marks)

    def finish(batches):
        for part, data, borders in text_steps(batches, "text"):
            words = words_of(data, borders)
            places, row = flatten(part.column(part.num_columns - 2))
            hashes, _ = flatten(part.column(part.num_columns - 1))
            starts = places.view(np.int64) + words.borders[row]
            # rows that share an id share what was found: only a text that has the window there has it
            inside = starts + passage <= words.borders[row + 1]
            starts, hashes = starts[inside], hashes[inside]
            starts = starts[run_hashes(words.hashes, starts, starts + passage) == hashes]
            change = np.zeros(len(words.hashes) + 1, np.int64)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + passage, -1)
            yield make(part, data, words, np.cumsum(change)[:-1] > 0)

    joined = rows.join(later, "_doc", "left").select(doc_id, "text", *columns, "_starts", "_hashes")
    return joined.mapInArrow(finish, schema)


def passage_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", passage: int = PASSAGE) -> DataFrame:
    """The passages to remove: doc_id, start (word, from 0), n_words, and the document's word count.

    One row for each longest run of words covered by windows of `passage` words that also start
    earlier, i.e. in a smaller doc_id, or in the same document before. The first copy of a passage
    gives no row, nor does a text without repeats. A null text has no words; a null id counts as the
    smallest. Rows that share an id are one document: among them only places decide, so repeated rows
    are not earlier than each other. No rows give no rows.
    """

    def make(part, data, words, covered):
        of = np.repeat(np.arange(len(words.borders) - 1), np.diff(words.borders))
        before = np.concatenate(([-1], of[:-1]))
        begins = covered & ~(np.concatenate(([False], covered[:-1])) & (before == of))
        starts = np.flatnonzero(begins)
        run = np.cumsum(begins)[covered] - 1
        lengths = np.bincount(run, minlength=len(starts))
        row = of[starts]
        return pa.RecordBatch.from_arrays(
            [
                part.column(0).cast(pa.int64()).take(pa.array(row)),
                pa.array(starts - words.borders[row]),
                pa.array(lengths.astype(np.int64)),
                pa.array(np.diff(words.borders)[row]),
            ],
            names=["doc_id", "start", "n_words", "doc_words"],
        )

    return repeated_passages(docs, make, "doc_id long, start long, n_words long, doc_words long", doc_id, text, passage=passage)


def remove_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    columns: tuple[str, ...] = (),
    passage: int = PASSAGE,
) -> DataFrame:
    """The documents without passages that also start earlier: doc_id, text, the columns, n_removed.

    A removed passage goes with the white space after it; the rest of a text stays as it is. A text
    that is all repeats becomes empty, a null text stays null. Other rules as in passage_spans.
    """
    kinds = {field.name: field.dataType.simpleString() for field in docs.schema.fields}
    schema = ", ".join(f"`{name}` {kinds[name]}" for name in (doc_id, text, *columns)) + ", n_removed long"

    def make(part, data, words, covered):
        raw, texts = data.tobytes(), part.column(1).to_pylist()
        removed = np.diff(np.concatenate(([0], np.cumsum(covered)))[words.borders])
        change = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
        for row in np.flatnonzero(removed):
            a, b = words.borders[row], words.borders[row + 1]
            inner = change[(change > a) & (change < b)].tolist()
            edges = [int(a), *inner, int(b)]
            gone, pieces = bool(covered[a]), []
            for start, end in zip(edges, edges[1:], strict=False):
                if not gone:
                    stop = words.starts[end] if end < b else words.ends[b - 1]
                    pieces.append(raw[words.starts[start] : stop])
                gone = not gone
            texts[row] = b"".join(pieces).decode("utf-8", "replace")
        rest = [part.column(i) for i in range(2, 2 + len(columns))]
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(texts, pa.string()), *rest, pa.array(removed)],
            names=[doc_id, text, *columns, "n_removed"],
        )

    return repeated_passages(docs, make, schema, doc_id, text, columns, passage)

"""Best-fit packing of token sequences by hierarchical residual packing."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import Store, text_steps
from tollgate.llm.tokens import encoder

CAPACITY = 2048
#: A bin with at most that many free places is nearly full and leaves the tree.
SLACK = 8
#: Underfull bins one task passes up to the next level at most; it closes the fullest beyond that.
PASSED_UP = 20_000
#: Tasks of a level whose residue one task of the next level packs.
FAN_IN = 8
#: Items one best-fit run holds at once.
RUN_ITEMS = 200_000

BINS = (
    "closed boolean, sequence_id long, fill int, members array<struct<"
    "doc_id: long, piece: int, start: long, length: long, ids_crc32: long, offset: long>>"
)


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing: the bin of each item.

    Bins lie in stacks by free places; the bits of one integer say which stacks hold a bin, so the
    fullest bin that still takes an item is the lowest set bit from its size upwards.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled, bins = 0, 0
    chosen = np.empty(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = filled >> size
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + size
            target = stacks[free].pop()
            if not stacks[free]:
                filled ^= 1 << free
        else:
            target, free, bins = bins, capacity, bins + 1
        free -= size
        stacks[free].append(target)
        filled |= 1 << free
        chosen[i] = target
    return chosen


def cut(doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray, capacity: int, end_id: int) -> dict[str, list]:
    """The pieces of some documents, as columns."""
    rows: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
    ids = ids.astype("<u4")
    last = np.array([end_id], "<u4")
    for row, doc_id in enumerate(doc_ids.to_pylist()):
        whole = np.concatenate((ids[ends[row] : ends[row + 1]], last))
        for number, start in enumerate(range(0, len(whole), capacity)):
            own = whole[start : start + capacity]
            rows["doc_id"].append(doc_id)
            rows["piece"].append(number)
            rows["start"].append(start)
            rows["length"].append(len(own))
            rows["ids_crc32"].append(zlib.crc32(own.tobytes()))
    return rows


def members(rows: dict[str, list]) -> pa.Array:
    """One list of one member for each piece."""
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    fields = [pa.array(values, kind) for values, kind in zip(rows.values(), kinds, strict=True)]
    none = pa.array(np.zeros(len(rows["doc_id"]), np.int64))
    row = pa.StructArray.from_arrays([*fields, none], [*rows, "offset"])
    return pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32)), row)


def offset_in_bin(rows: pa.StructArray, starts: np.ndarray) -> pa.StructArray:
    """The members with their offsets counted anew: the lengths before them in their bin."""
    names = [field.name for field in rows.type]
    fields = dict(zip(names, rows.flatten(), strict=True))
    before = np.concatenate(([0], np.cumsum(fields["length"].to_numpy())))
    fields["offset"] = pa.array(before[:-1] - np.repeat(before[starts[:-1]], np.diff(starts)))
    return pa.StructArray.from_arrays([fields[name] for name in names], names)


class Packer:
    """Packs items, lists of pieces with a fill, and hands on what one run leaves underfull to the next."""

    def __init__(self, level: int, capacity: int, slack: int, passed_up: int):
        self.capacity, self.slack, self.passed_up = capacity, slack, passed_up
        self.number = (level << 56) | (TaskContext.get().partitionId() << 28)
        self.items: list[tuple[pa.Array, np.ndarray]] = []
        self.waiting = 0

    def add(self, lists: pa.Array, fills: np.ndarray):
        self.items.append((lists, fills))
        self.waiting += len(fills)
        if self.waiting >= RUN_ITEMS:
            yield self.pack(False)

    def finish(self):
        if self.waiting:
            yield self.pack(True)

    def pack(self, final: bool) -> pa.RecordBatch:
        """Closed bins, and in the final run also the bins that go up; else those wait for more items."""
        lists = pa.concat_arrays([one for one, _ in self.items])
        fills = np.concatenate([one for _, one in self.items])
        bin_of = best_fit(fills, self.capacity)
        order = np.argsort(bin_of, kind="stable")
        total = np.bincount(bin_of, weights=fills).astype(np.int64)
        lists = lists.take(pa.array(order))
        # the lists of a bin's items become one list
        lengths = np.diff(lists.offsets.to_numpy())
        merged = np.bincount(bin_of[order], weights=lengths).astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(merged))).astype(np.int32)
        bins = pa.ListArray.from_arrays(pa.array(offsets), offset_in_bin(lists.flatten(), offsets))
        closed = total >= self.capacity - self.slack
        under = np.flatnonzero(~closed)
        if len(under) > self.passed_up:
            fullest = under[np.argsort(-total[under], kind="stable")]
            closed[fullest[: len(under) - self.passed_up]] = True
        leave = np.ones(len(total), bool) if final else closed
        if not final:
            kept = pa.array(np.flatnonzero(~closed))
            self.items, self.waiting = [(bins.take(kept), total[~closed])], int((~closed).sum())
        numbers = self.number + np.arange(int(leave.sum()))
        self.number += len(numbers)
        out = pa.array(np.flatnonzero(leave))
        return pa.RecordBatch.from_arrays(
            [pa.array(closed[leave]), pa.array(numbers), pa.array(total[leave].astype(np.int32)), bins.take(out)],
            names=["closed", "sequence_id", "fill", "members"],
        )


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    capacity: int = CAPACITY,
    slack: int = SLACK,
    passed_up: int = PASSED_UP,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Pack the token ids of documents, each with end_id after it, into sequences of capacity tokens.

    Documents longer than that are cut into pieces of capacity tokens and a rest. Gives per piece
    doc_id, piece (from 0), start (the document's ids before it), length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit), sequence_id and offset (gapless from 0 in each sequence).

    Level 0 packs inside each input partition, right after tokenising: best-fit decreasing. Bins with
    at most slack free places are closed and leave; the others go up as items of the next level, where
    one task packs the residue of fan_in tasks, until one task is left. A task passes up at most
    passed_up bins, those with most room, and closes the rest, so no task's residue grows with the
    table; only the last fraction of a bin's room is lost by that, never a piece.

    tokenizer is a path valid on every machine. A null text is an empty one: a piece with end_id
    alone. Rows with a null or repeated id are documents of their own. Other columns are not read;
    no rows give no rows.
    """
    store = Store(docs.sparkSession, "packing")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def first(batches):
        coder = encoder(tokenizer)
        packer = Packer(0, capacity, slack, passed_up)
        for part, data, borders in text_steps(batches, "text"):
            ids, ends = coder.encode(data, borders)
            own = cut(part.column(0), ids, ends, capacity, end_id)
            yield from packer.add(members(own), np.array(own["length"], np.int64))
        yield from packer.finish()

    def merge(level: int):
        def run(batches):
            packer = Packer(level, capacity, slack, passed_up)
            for batch in batches:
                yield from packer.add(pa.array(batch.column(3)), batch.column(2).to_numpy().astype(np.int64))
            yield from packer.finish()

        return run

    bins = store.keep(rows.mapInArrow(first, BINS), "level")
    done = [bins.where("closed")]
    tasks, level = bins.select(F.shiftright("sequence_id", 28)).distinct().count(), 0
    while True:
        tasks, level = max(1, -(-tasks // fan_in)), level + 1
        residue = bins.where("not closed").repartition(tasks)
        bins = store.keep(residue.mapInArrow(merge(level), BINS), "level")
        done.append(bins.where("closed"))
        if tasks == 1:
            break
    done.append(bins.where("not closed"))
    packed = done[0]
    for part in done[1:]:
        packed = packed.unionByName(part)
    placed = packed.select("sequence_id", F.explode("members").alias("one"))
    return placed.select("one.doc_id", "one.piece", "one.start", "one.length", "one.ids_crc32", "sequence_id", "one.offset")

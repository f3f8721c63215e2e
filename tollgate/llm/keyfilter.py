"""A filter of 64-bit keys of bounded size: it lets every key of a set pass, and few others."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tollgate.llm.words import scramble

#: Bits of a filter: 16 for each key, between these bounds. At most 32 MB are ever broadcast.
LEAST_BITS, MOST_BITS = 16, 28
#: Both bits of a key lie in one block of so many bits (as a power of two).
BLOCK_BITS = 16
LOW = np.uint64((1 << BLOCK_BITS) - 1)


def places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each key."""
    mixed = scramble(keys.view(np.uint64))
    block = (mixed >> np.uint64(32)) & np.uint64((1 << (bits - BLOCK_BITS)) - 1)
    block <<= np.uint64(BLOCK_BITS)
    return block | (mixed & LOW), block | ((mixed >> np.uint64(BLOCK_BITS)) & LOW)


def block_bits(bits: int):
    """A task that turns keys, sorted by block, into (block, its bits as bytes)."""

    def task(batches):
        now, held = -1, None
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key")).to_numpy(zero_copy_only=False)
            one, two = places(keys, bits)
            blocks = (one >> np.uint64(BLOCK_BITS)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for first, last in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                if first == last:
                    continue
                if blocks[first] != now:
                    if held is not None:
                        yield row(now, held)
                    now, held = int(blocks[first]), np.zeros(1 << BLOCK_BITS, bool)
                held[one[first:last] & LOW] = True
                held[two[first:last] & LOW] = True
        if held is not None:
            yield row(now, held)

    def row(block, held):
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([np.packbits(held).tobytes()], pa.binary())],
            names=["block", "bits"],
        )

    return task


def block_of(bits: int):
    def task(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            one, _ = places(keys, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array((one >> np.uint64(BLOCK_BITS)).astype(np.int64)), batch.column(0)], names=["block", "key"]
            )

    return task


class KeyFilter:
    """What tasks need to test keys: the bits, broadcast once. A key of the set always passes."""

    def __init__(self, keys: DataFrame, most_bits: int = MOST_BITS):
        """keys: one long column, key, from a stored table. Beyond most_bits / 16 keys more others pass."""
        spark = keys.sparkSession
        count = keys.count()
        self.bits = min(max(LEAST_BITS, (16 * count).bit_length()), most_bits)
        found = np.zeros(1 << (self.bits - 3), np.uint8)
        if count:
            dealt = keys.mapInArrow(block_of(self.bits), "block long, key long")
            dealt = dealt.repartition("block").sortWithinPartitions("block")
            size = 1 << (BLOCK_BITS - 3)
            for one in dealt.mapInArrow(block_bits(self.bits), "block long, bits binary").collect():
                found[one["block"] * size : (one["block"] + 1) * size] = np.frombuffer(one["bits"], np.uint8)
        self.shared = spark.sparkContext.broadcast(found)

    def passing(self, keys: np.ndarray) -> np.ndarray:
        """True for every key that may be in the set."""
        bits = self.shared.value
        good = np.ones(len(keys), bool)
        for at in places(keys, self.bits):
            here = bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)
            good &= (here & 1).astype(bool)
        return good

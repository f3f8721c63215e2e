"""Exact top-k by inner product: histogram selection of every query's k-th score."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import Store, finite

ROWS = 2048
LOWEST = np.iinfo(np.int64).min
SAFE = float(2**53)


def matrix(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the vectors, and all their components one after the other."""
    column = column.cast(pa.large_list(column.type.value_type))
    lengths = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1])
    return lengths, column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)


def blocks(ids: np.ndarray, lengths: np.ndarray, values: np.ndarray, rows: int = ROWS):
    """Rows of one length at a time, at most so many: ids and a matrix."""
    starts = np.concatenate(([0], np.cumsum(lengths)))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        for first in range(0, len(at), rows):
            part = at[first : first + rows]
            yield int(length), ids[part], values[starts[part][:, None] + np.arange(length)]


def inner(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: floating point only where every partial sum is an integer it holds."""
    bound = np.abs(queries).max(initial=0).astype(float) * np.abs(rows).max(initial=0).astype(float)
    bound *= max(queries.shape[1], 1)
    if bound < SAFE:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if bound < 2.0**62:
        return queries @ rows.T
    exact = queries.astype(object) @ rows.astype(object).T
    if any(abs(x) >= 2**63 for x in exact.flat):
        raise OverflowError("an inner product does not fit a long")
    return exact.astype(np.int64)


class Block:
    """One block of queries, and for each the range in which its k-th score lies."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, values: np.ndarray):
        self.ids, self.by_length = ids, {}
        starts = np.concatenate(([0], np.cumsum(lengths)))
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            self.by_length[int(length)] = (at, values[starts[at][:, None] + np.arange(length)])

    def scores(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Positions of queries, ids of rows, scores; a query's own rows score LOWEST."""
        lengths, values = matrix(batch.column(1), np.int64)
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for length, row_ids, rows in blocks(ids, lengths, values):
            if length in self.by_length:
                at, queries = self.by_length[length]
                found = inner(queries, rows)
                found[self.ids[at][:, None] == row_ids[None, :]] = LOWEST
                yield at, row_ids, found


def histograms(block: Block, low: np.ndarray, width: np.ndarray, bins: int, k: int):
    """Per task: how many scores of each query fall in each bin from its low upwards.

    The last bin also counts all scores beyond it. Bins below the task's own k-th score cannot hold the k-th score of all rows and are left out.
    """

    def run(batches):
        counts = np.zeros((len(block.ids), bins), np.int64)
        for batch in batches:
            for at, _, found in block.scores(batch):
                bin_of = np.minimum((found - low[at, None]) // width[at, None], bins - 1)
                inside = (found != LOWEST) & (found >= low[at, None])
                flat = (at[:, None] * bins + bin_of)[inside]
                counts += np.bincount(flat, minlength=counts.size).reshape(counts.shape)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        query, bin_no = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(bin_no), pa.array(counts[query, bin_no])],
            names=["query", "bin", "n"],
        )

    return run


def leaders(block: Block, low: np.ndarray, k: int):
    """Scores from each query's low upwards; of ties within a batch, the k smallest ids."""

    def run(batches):
        for batch in batches:
            for at, row_ids, found in block.scores(batch):
                order = np.argsort(row_ids, kind="stable")
                row_ids, found = row_ids[order], found[:, order]
                keep = (found >= low[at, None]) & (found != LOWEST)
                for row in np.flatnonzero(keep.any(axis=1)):
                    cols = np.flatnonzero(keep[row])
                    best = cols[np.argsort(-found[row, cols], kind="stable")[:k]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(best), block.ids[at[row]])),
                            pa.array(row_ids[best]),
                            pa.array(found[row, best]),
                        ],
                        names=["query_id", "vec_id", "score"],
                    )

    return run


def narrow(counts, low, width, bins: int, k: int) -> None:
    """Move every query's range to the bin that holds its k-th score."""
    table = np.zeros((len(low), bins), np.int64)
    for query, bin_no, n in counts:
        table[query, bin_no] = n
    upper = np.cumsum(table[:, ::-1], axis=1)[:, ::-1]
    reach = upper >= k
    enough = reach.any(axis=1)
    bin_of = np.where(enough, bins - 1 - np.argmax(reach[:, ::-1], axis=1), 0)
    low += np.where(enough, bin_of * width, 0)
    width[:] = np.where(enough, -(-width // bins), 1)


def exact_top_k(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 5,
    scale: int = 256,
    query_every: int = 50,
    query_block: int = 4096,
    bins: int = 256,
) -> DataFrame:
    """Each query's k best rows by the integer inner product of floor(scale * x), exactly.

    Queries are the rows whose id is divisible by query_every; they go in blocks of query_block,
    the size bound of what is broadcast and of what the driver holds of the histograms. A block
    scores all rows in each pass: the passes count scores in ever finer bins until the k-th score
    is known, the last one keeps what reaches it. Columns: query_id, rank, vec_id, score.

    Rows without id, and vectors that are null or hold null or non-finite components, take no part;
    other columns are not read. Vectors of different lengths have no score. Rows that share an id
    are one another's own rows; a query id that occurs repeatedly asks once, with its smallest vector.
    Ties go to the smaller id. No rows give no rows. A score beyond a long raises OverflowError.
    """
    spark = vectors.sparkSession
    store = Store(spark, "topk")
    whole = F.transform(vector_column, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.where(F.col(id_column).isNotNull() & finite(F.col(vector_column))).select(
        F.col(id_column).cast("long").alias("vec_id"), whole.alias("vector")
    )
    asked = rows.where(F.col("vec_id") % query_every == 0)
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    found_at, last, schema = store.path("found"), None, "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(found_at)
    while True:
        more = asked if last is None else asked.where(F.col("vec_id") > last)
        part = more.orderBy("vec_id").limit(query_block).toArrow()
        if part.num_rows == 0:
            break
        ids = part.column(0).to_numpy()
        last = int(ids[-1])
        lengths, values = matrix(part.column(1).combine_chunks(), np.int64)
        low = select(rows, Block(ids, lengths, values), k, bins)
        shared = spark.sparkContext.broadcast((Block(ids, lengths, values), low))

        def keep(batches, shared=shared):
            block, low = shared.value
            yield from leaders(block, low, k)(batches)

        best = rows.mapInArrow(keep, "query_id long, vec_id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(found_at)
        shared.destroy()
    return spark.read.schema(schema).parquet(found_at)


def select(rows: DataFrame, block: Block, k: int, bins: int) -> np.ndarray:
    """The k-th score of every query; where there are fewer scores, a bound below all of them."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    largest = rows.agg(F.max(F.sqrt(square))).first()[0]
    size = len(block.ids)
    low, width = np.zeros(size, np.int64), np.ones(size, np.int64)
    for at, queries in block.by_length.values():
        reach = np.sqrt((queries.astype(float) ** 2).sum(axis=1)) * largest * (1 + 1e-9) + 1
        reach = np.minimum(reach, 2.0**61).astype(np.int64)
        low[at], width[at] = -reach, -(-(2 * reach + 1) // bins)
    while True:
        shared = rows.sparkSession.sparkContext.broadcast((block, low, width))

        def count(batches, shared=shared):
            block, low, width = shared.value
            yield from histograms(block, low, width, bins, k)(batches)

        counted = rows.mapInArrow(count, "query long, bin long, n long")
        counts = counted.groupBy("query", "bin").agg(F.sum("n").alias("n")).collect()
        exact = bool((width == 1).all())
        narrow(counts, low, width, bins, k)
        shared.destroy()
        if exact:
            return low

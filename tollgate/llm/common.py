"""What the operators of this package share: tables, durable intermediates, batches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import fresh_path, ship_package

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text a Python task holds at once, beyond a single longer document.
STEP_BYTES = 2_000_000
#: Bytes of the tables that bound a kept one for which a task of its own writes a file.
FILE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the jobs inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the jobs inside go when each job ends; the tables they write stay."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession):
    """Batches of at most 8 MB go to the Python tasks of the jobs inside, which hold much besides."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", "8m")


class Store:
    """Intermediate tables in the shared folder, dropped when they are no longer needed."""

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        self.spark, self.name = spark, name

    def path(self, name: str) -> str:
        return fresh_path(self.spark, f"{self.name}-{name}")

    def keep(self, df: DataFrame, name: str, *partition_by: str, within: tuple[DataFrame, ...] = ()) -> DataFrame:
        """Write a table and read it back: lineage ends here and a lost executor loses nothing.

        within: kept tables that this one, and what its last stage reads, do not outgrow. Then so many files
        are written as those tables have bytes, two a core at least, however many partitions there are.
        """
        if within:
            size = sum(stored_bytes(self.spark, one._store_path) for one in within)
            df = df.coalesce(max(2 * self.spark.sparkContext.defaultParallelism, -(-size // FILE_BYTES)))
        path = self.path(name)
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with shuffles_dropped(self.spark):
            writer.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._store_path = path
        return kept

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            remove_path(self.spark, df._store_path)


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most that many rows; reads no further."""
    return df.limit(rows + 1).count() <= rows


def finite(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components."""

    def good(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce(vector.isNotNull() & F.forall(vector, good), F.lit(False))


def text_steps(
    batches: Iterator[pa.RecordBatch], column: str, step_bytes: int = STEP_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows of about step_bytes of text.

    Gives the rows, the UTF-8 bytes of all their texts in one array, and the texts' borders in it
    (one more than rows). A null text has no bytes.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        row = 0
        while row < len(batch):
            end = int(np.searchsorted(offsets, offsets[row] + step_bytes, side="right")) - 1
            end = min(max(end, row + 1), len(batch))
            borders = offsets[row : end + 1]
            yield batch.slice(row, end - row), data[borders[0] : borders[-1]], borders - borders[0]
            row = end


def longs(*names: str) -> str:
    return ", ".join(f"{name} long" for name in names)

"""Session settings the operators are designed for, and the durable folder they share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tollgate")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**SETTINGS, **STREAM_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir where set.

    Only a session without that setting on one machine, as in tests, gets a fresh local folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if configured is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tollgate-"))
    return configured or context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_durable(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_split(df: DataFrame, name: str, column: str, ways: int) -> DataFrame:
    """``write_durable`` with a folder per value of a column of at most ``ways`` values.

    A task keeps a file open for each value and does not sort its rows by them first.
    """
    with _settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(ways)}):
        return write_durable(df, name, column)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Give a file this text: by a rename, so a reader sees the old or the new one, whole."""
    folders = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = folders.Path(path)
    part = folders.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = part.getFileSystem(conf).create(part, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = getattr(folders, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    folders.FileContext.getFileContext(conf).rename(part, target, options)


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings for the stateful queries started inside; a query keeps what it started with.

    The number of state partitions is fixed when a query first starts: ``partitions``, which should
    suit the largest cluster the query may come to run on, or else the session's cores.
    """
    count = partitions or spark.sparkContext.defaultParallelism
    with _settings(spark, {**STREAM_SETTINGS, "spark.sql.shuffle.partitions": str(count)}):
        yield


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, which need it for Python functions; once per application.

    A cluster refuses a second file of the same name from another folder.
    """
    context = spark.sparkContext
    if getattr(context, "_tollgate_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tollgate-pkg-")
    archive = shutil.make_archive(
        os.path.join(folder, "tollgate_pkg"), "zip", os.path.dirname(root), "tollgate"
    )
    context.addPyFile(archive)
    context._tollgate_shipped = True

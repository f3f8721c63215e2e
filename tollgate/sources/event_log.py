"""The event log as source and sink: Kafka on a cluster, files with the same columns elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.config import ProcessorConfig
from tollgate.schemas import ENRICHED, LOG


def read_topic(spark: SparkSession, cfg: ProcessorConfig) -> DataFrame:
    """Stream of a Kafka topic from its start; a restart goes on from the checkpoint.

    Needs the spark-sql-kafka package.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", cfg.brokers)
        .option("subscribe", cfg.input_topic)
        .option("startingOffsets", "earliest")
        .option("kafka.isolation.level", "read_committed")
        .option("maxOffsetsPerTrigger", cfg.max_offsets_per_trigger)
        .load()
        .select(*LOG.fieldNames())
    )


def read_log_files(spark: SparkSession, path: str, cfg: ProcessorConfig, fmt: str = "parquet") -> DataFrame:
    """Stream of log records kept as files."""
    return (
        spark.readStream.schema(LOG)
        .option("maxFilesPerTrigger", cfg.max_files_per_trigger)
        .format(fmt)
        .load(path)
    )


def keyed_json(df: DataFrame, key: str = "account_id") -> DataFrame:
    """Rows as (key, value): the key column and the whole row as JSON with its nulls."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def with_error_header(dead_letters: DataFrame) -> DataFrame:
    """Dead letters as (value, headers), the error type in a header."""
    header = F.struct(
        F.lit("error_type").alias("key"), F.col("error_type").cast("binary").alias("value")
    )
    return dead_letters.select(
        F.to_json(F.struct(*dead_letters.columns)).alias("value"), F.array(header).alias("headers")
    )


def write_topic(df: DataFrame, cfg: ProcessorConfig, topic: str | None = None) -> None:
    """Append (key, value[, headers]) rows to a topic. Needs the spark-sql-kafka package."""
    (
        df.write.format("kafka")
        .option("kafka.bootstrap.servers", cfg.brokers)
        .option("topic", topic or cfg.output_topic)
        .option("includeHeaders", str("headers" in df.columns).lower())
        .save()
    )


def tail_view(messages: DataFrame, value: Column | None = None) -> DataFrame:
    """The seven columns an operator watches, from enriched JSON messages."""
    text = F.col("value").cast("string") if value is None else value
    row = F.from_json(text, ENRICHED)
    country, city = F.col("_row.geo_country"), F.coalesce("_row.geo_city", F.lit("None"))
    return messages.select(row.alias("_row")).select(
        "_row.transaction_id",
        "_row.account_id",
        "_row.vel_count_1m",
        F.when(country.isNull(), F.lit("geo=null"))
        .otherwise(F.concat(country, F.lit(" / "), city))
        .alias("geo"),
        "_row.device_txn_count",
        "_row.enrichment_latency_ms",
        "_row.vel_amount_1m",
    )

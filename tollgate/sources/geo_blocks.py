"""Network block table: the source of locations."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tollgate.operators.geo import network_blocks

BLOCKS = T.StructType(
    [
        T.StructField("network", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
    ]
)


def read_blocks(spark: SparkSession, path: str | None, fmt: str = "parquet") -> DataFrame:
    """Blocks from a (network, country, city) table; a missing table gives no blocks, not an error."""
    empty = spark.createDataFrame([], BLOCKS)
    if path is None:
        return network_blocks(empty)
    reader = spark.read.schema(BLOCKS).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    try:
        return network_blocks(reader.load(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return network_blocks(empty)
        raise

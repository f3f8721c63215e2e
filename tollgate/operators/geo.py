"""Location of a subnet by longest matching network block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.config import SkewConfig
from tollgate.functions import ip
from tollgate.operators.skew import lookup_join
from tollgate.schemas import ARRIVAL, GEO

_KEYS = ["width", "prefix_len", "net_bits"]

# Stamped on every resolved subnet.
DEFAULT_CLASS = "RESIDENTIAL"
DEFAULT_CONFIDENCE = 0.9


def network_blocks(blocks: DataFrame) -> DataFrame:
    """(network, country, city) to one row per block keyed by its leading address bits.

    Rows whose network does not parse are left out.
    """
    bits = ip.address_bits(F.split_part("network", F.lit("/"), F.lit(1)))
    prefix = F.split_part("network", F.lit("/"), F.lit(2)).try_cast("int")
    return (
        blocks.select(bits.alias("_bits"), prefix.alias("prefix_len"), "country", "city")
        .withColumn("width", F.length("_bits"))
        .where(F.col("prefix_len").between(0, F.col("width")))
        .withColumn("net_bits", F.left("_bits", F.col("prefix_len")))
        .groupBy(*_KEYS)
        .agg(F.min(F.struct("country", "city")).alias("_place"))
        .select(*_KEYS, "_place.country", "_place.city")
    )


def resolve_subnets(subnets: DataFrame, blocks: DataFrame, confidence: str = "fixed") -> DataFrame:
    """Geo columns per distinct subnet that lies in some block.

    One equi-join candidate per prefix length that occurs in the blocks (at most 162 lengths, so
    that list is broadcast); the longest match wins. Which side of the block join is broadcast,
    if any, is left to the planner's size check.
    """
    lengths = blocks.select("width", "prefix_len").distinct()
    bits = ip.address_bits(ip.representative_host(F.col("caller_ip_subnet")))
    candidates = (
        subnets.select("caller_ip_subnet", bits.alias("_bits"))
        .withColumn("width", F.length("_bits"))
        .join(F.broadcast(lengths), "width")
        .withColumn("net_bits", F.left("_bits", F.col("prefix_len")))
    )
    best = (
        candidates.join(blocks, _KEYS)
        .groupBy("caller_ip_subnet")
        .agg(F.max_by(F.struct("country", "city"), "prefix_len").alias("_place"))
    )
    country, city = F.col("_place.country"), F.col("_place.city")
    if confidence == "fixed":
        score = F.lit(DEFAULT_CONFIDENCE)
    elif confidence == "precision":
        score = F.when(city.isNotNull(), 1.0).when(country.isNotNull(), 0.5).otherwise(0.0)
    else:
        raise ValueError(f"unknown confidence rule: {confidence!r}")
    return best.select(
        "caller_ip_subnet",
        country.alias("geo_country"),
        city.alias("geo_city"),
        F.lit(DEFAULT_CLASS).alias("geo_network_class"),
        score.cast("float").alias("geo_confidence"),
    )


def geolocate(
    df: DataFrame,
    blocks: DataFrame,
    skew: SkewConfig | None = None,
    confidence: str = "fixed",
    arrival: Sequence[str] = ARRIVAL,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add the four geo columns; all null where no block matches.

    Each distinct subnet is looked up once, however many rows carry it. ``base`` may name a
    cheaper table with the same rows.
    """
    base = df if base is None else base
    counts = base.groupBy("caller_ip_subnet").agg(F.count(F.lit(1)).alias("_n"))
    found = resolve_subnets(counts, blocks, confidence)
    return lookup_join(
        df, found, ["caller_ip_subnet"], arrival, skew or SkewConfig(), counts, base
    ).select(*df.columns, *GEO.fieldNames())

"""Settings, as frozen dataclasses that operators take as arguments."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS


@dataclass(frozen=True)
class SkewConfig:
    """When a group counts as hot, and how a hot group is divided.

    A group is hot above ``max(hot_rows, total_rows * hot_share)`` rows, so there are never more
    than ``1 / hot_share`` hot groups: that is the size bound of every broadcast of hot keys.
    """

    hot_rows: int = 1_000_000
    hot_share: float = 1e-5
    block_rows: int = 65_536
    salts: int = 256


@dataclass(frozen=True)
class MaskingConfig:
    ipv4_prefix: int = 24
    ipv6_prefix: int = 64
    lib_version: str = "1.0.0"

    @classmethod
    def from_env(cls) -> MaskingConfig:
        env = os.environ
        return cls(
            ipv4_prefix=int(env.get("MASKING_IPV4_PREFIX", "24")),
            ipv6_prefix=int(env.get("MASKING_IPV6_PREFIX", "64")),
        )


@dataclass(frozen=True)
class IngestConfig:
    topic: str = "txn.api"
    dlq_topic: str = "txn.api.dlq"
    max_skew_ms: int = 5 * MINUTE_MS
    channel: str = "API"
    keep_channel: bool = False
    require_uuid: bool = False
    schema_version: str = "1"
    masking: MaskingConfig = field(default_factory=MaskingConfig)


@dataclass(frozen=True)
class ProcessorConfig:
    brokers: str = "localhost:9092"
    input_topic: str = "txn.api"
    output_topic: str = "txn.enriched"
    dlq_topic: str = "txn.processing.dlq"
    checkpoint_dir: str | None = None
    checkpoint_interval_ms: int = 60_000
    geo_blocks_path: str | None = None
    watermark_ooo_seconds: int = 10
    allowed_lateness_seconds: int = 30
    dedup_ttl_ms: int = 48 * HOUR_MS
    device_idle_ms: int = 7 * DAY_MS
    velocity_mode: str = "bucket"
    geo_confidence: str = "fixed"
    processor_version: str = "tollgate@1.0.0"
    schema_version: str = "1"
    expected_schema_id: int | None = None
    max_offsets_per_trigger: int = 5_000_000
    max_files_per_trigger: int = 1_000
    skew: SkewConfig = field(default_factory=SkewConfig)

    @property
    def watermark_ms(self) -> int:
        return self.watermark_ooo_seconds * 1000

    @property
    def lateness_ms(self) -> int:
        return self.allowed_lateness_seconds * 1000

    @classmethod
    def from_env(cls) -> ProcessorConfig:
        env = os.environ
        return cls(
            brokers=env.get("KAFKA_BOOTSTRAP_SERVERS", cls.brokers),
            input_topic=env.get("INPUT_TOPIC", cls.input_topic),
            output_topic=env.get("OUTPUT_TOPIC", cls.output_topic),
            dlq_topic=env.get("DLQ_TOPIC", cls.dlq_topic),
            checkpoint_dir=env.get("CHECKPOINT_DIR"),
            checkpoint_interval_ms=int(
                env.get("CHECKPOINT_INTERVAL_MS", cls.checkpoint_interval_ms)
            ),
            geo_blocks_path=env.get("GEO_BLOCKS_PATH"),
            watermark_ooo_seconds=int(env.get("WATERMARK_OOO_SECONDS", cls.watermark_ooo_seconds)),
            allowed_lateness_seconds=int(
                env.get("ALLOWED_LATENESS_SECONDS", cls.allowed_lateness_seconds)
            ),
            processor_version=env.get("PROCESSOR_VERSION", cls.processor_version),
        )

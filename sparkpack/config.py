"""Settings that change data. Defaults are the delivery contract's defaults; queries on test data scale them."""
from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class PackConfig:
    # packing
    aggregation_enabled: bool = True
    aggregation_max_count: int = 4_294_967_295
    aggregation_max_size: int = 51_200
    collection_max_count: int = 500
    collection_max_size: int = 5_242_880
    shard_burst_size: int = 262_144
    # timing, milliseconds
    record_max_buffered_ms: int = 100
    record_ttl_ms: int = 30_000
    # shaping: per-shard capacity, refill is capacity * rate_limit_percent / 100 per second
    shard_records_per_sec: float = 1000.0
    shard_bytes_per_sec: float = 1_048_576.0
    rate_limit_percent: int = 150
    # outcomes and metrics
    fail_if_throttled: bool = False
    metrics_level: str = "detailed"
    metrics_granularity: str = "shard"
    metrics_window_s: int = 60
    metrics_batch_size: int = 20
    # physical layout: how ordered scans are cut so that no (stream, shard) is one task
    slice_ms: int = 60_000
    block_cost: int = 64 * 1024 * 1024
    block_ms: int = 600_000

    def with_(self, **changes) -> "PackConfig":
        return replace(self, **changes)

    @property
    def record_rate(self) -> float:
        return self.shard_records_per_sec * self.rate_limit_percent / 100.0

    @property
    def byte_rate(self) -> float:
        return self.shard_bytes_per_sec * self.rate_limit_percent / 100.0

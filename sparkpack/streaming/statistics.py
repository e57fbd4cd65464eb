"""Streaming statistics in buckets of time that late samples re-open."""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sparkpack.streaming.clock import event_clock

PARTIALS = "dims string, bucket long, count long, sum double, min double, max double, correction boolean"
_COLUMNS = [c.split()[0] for c in PARTIALS.split(", ")]


class BucketProcessor(StatefulProcessor):
    """Per metric a ring of open buckets: number of the bucket -> count, sum, min, max.

    A bucket leaves as one partial when the event clock has passed its end, and its place in the ring is free again. Samples
    of a bucket that has left re-open it for this micro-batch and leave at once, as a partial marked as a correction.
    Partials of one bucket merge, so counts are exact however late a sample comes.
    """

    def __init__(self, width_us: int):
        self.width = width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "bucket long", "count long, sum double, min double, max double")
        self.timer = handle.getValueState("timer", "ms long")

    def _rows(self, key, buckets: list[tuple], correction: bool) -> list[tuple]:
        return [(key[0], *b, correction) for b in buckets]

    def _wake(self) -> None:
        """One timer a metric: the end of its earliest open bucket."""
        first = min((k[0] for k in self.open.keys()), default=None)
        wanted = None if first is None else -(-(first + 1) * self.width // 1000)
        have = self.timer.get()[0] if self.timer.exists() else None
        if have == wanted:
            return
        if have is not None:
            self.handle.deleteTimer(have)
            self.timer.clear()
        if wanted is not None:
            self.handle.registerTimer(wanted)
            self.timer.update((wanted,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        some = [r.groupby("bucket", sort=True)[["count", "sum", "min", "max"]].agg({"count": "sum", "sum": "sum", "min": "min", "max": "max"}) for r in rows]
        new = pd.concat(some).groupby(level=0).agg({"count": "sum", "sum": "sum", "min": "min", "max": "max"})
        now, late = timerValues.getCurrentWatermarkInMs() * 1000, []
        for bucket, n, total, low, high in new.itertuples(name=None):
            bucket, n = int(bucket), int(n)
            if self.open.containsKey((bucket,)):
                n0, total0, low0, high0 = self.open.getValue((bucket,))
                self.open.updateValue((bucket,), (n0 + n, total0 + total, min(low0, low), max(high0, high)))
            elif (bucket + 1) * self.width <= now:
                late.append((bucket, n, total, low, high))
            else:
                self.open.updateValue((bucket,), (n, float(total), float(low), float(high)))
        self._wake()
        yield pd.DataFrame(self._rows(key, late, True), columns=_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) * 1000
        done = sorted((k[0], *v) for k, v in self.open.iterator() if (k[0] + 1) * self.width <= now)
        for bucket, *_ in done:
            self.open.removeKey((bucket,))
        self._wake()
        yield pd.DataFrame(self._rows(key, done, False), columns=_COLUMNS)

    def close(self) -> None:
        pass


def stream_buckets(samples: DataFrame, dims: Column, width_s: int, lateness: str = "10 seconds", salts: int = 1,
                   ticks: DataFrame | None = None) -> DataFrame:
    """Partials (dims, bucket, count, sum, min, max, correction) of samples with ts and value; merge them by dims and bucket.

    A metric that holds much of the data spreads over `salts` keys, since partials merge. `ticks` (ts) only move the clock.
    Null values count nothing, as in the batch statistics, but keep their bucket.
    """
    width = width_s * 1_000_000
    number = F.floor(F.unix_micros("ts") / width).cast("long")
    salt = F.pmod(F.xxhash64("ts", "value"), F.lit(salts)).cast("int")
    rows = samples.select(dims.alias("dims"), salt.alias("salt"), "ts", number.alias("bucket"), F.col("value").isNotNull().cast("long").alias("count"),
                          *[F.col("value").cast("double").alias(c) for c in ("sum", "min", "max")], F.lit(False).alias("tick"))
    if ticks is not None:
        rows = rows.unionByName(ticks.select("ts", F.lit(True).alias("tick")), allowMissingColumns=True)
    rows = event_clock(rows, F.col("ts"), lateness, F.col("tick"))
    return rows.groupBy("dims", "salt").transformWithStateInPandas(BucketProcessor(width), PARTIALS, "Append", "EventTime")

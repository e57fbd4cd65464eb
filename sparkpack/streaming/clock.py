"""Event time that moves timers but never drops a row."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLOCK = "_clock"


def event_clock(rows: DataFrame, at: Column, lateness: str = "0 seconds", tick: Column | None = None) -> DataFrame:
    """Rows with a watermark that follows `at`, for stateful operators with event-time timers.

    Spark drops rows behind a watermark before the state sees them. Here each row passes the watermark twice: once with its
    time, which moves the watermark and goes no further, and once without a time, which can't be late. Rows for which
    `tick` holds only move the watermark.
    """
    own, none = at.cast("timestamp"), F.lit(None).cast("timestamp")
    both = F.array(none, own)
    both = F.when(F.coalesce(tick, F.lit(False)), F.array(own)).otherwise(both) if tick is not None else both
    return rows.withColumn(CLOCK, F.explode(both)).withWatermark(CLOCK, lateness).filter(F.col(CLOCK).isNull())

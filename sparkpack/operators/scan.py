"""Ordered scans (running sum, row number, lag, last, running max) that never put one key into one task.

A plain `Window.partitionBy(key)` sends all rows of a hot key to one task. Here the order is cut into
slices; each (key, slice) is scanned on its own, the slice totals (one small row each, combined map-side)
are scanned per key, and the totals are joined back on the partitioning the rows already have.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.operators.stage import materialize

SLICE = "_slice"
RANGE = "_range"


def time_slice(ts: Column, slice_ms: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(slice_ms * 1000)).cast("bigint")


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partition by `columns` into the configured number of shuffle partitions. Steps that compute much per
    byte (folds, packing) ask for this, because adaptive execution would merge their small inputs into one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    slice_by: Column,
    order: list[Column],
    sums: dict[str, Column] | None = None,
    lags: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Add per-key running columns in `order`. `slice_by` must be non-null and non-decreasing along `order`;
    keys must be non-null.

    sums   -- inclusive running sums (use F.lit(1) for a row number)
    lags   -- value of the previous row, null on the first
    lasts  -- last non-null value up to and including the row
    totals -- sum over all rows of the key
    """
    sums, lags, lasts, totals = sums or {}, lags or {}, lasts or {}, totals or {}
    by = keys + [SLICE]
    base = df.withColumn(SLICE, slice_by)
    local = Window.partitionBy(*by).orderBy(*order)
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    at = F.struct(*order)

    rows = base.select(
        "*",
        *[F.sum(c).over(upto).alias(n) for n, c in sums.items()],
        *[F.lag(c).over(local).alias(n) for n, c in lags.items()],
        *[F.last(c, ignorenulls=True).over(upto).alias(n) for n, c in lasts.items()],
        *([F.row_number().over(local).alias("_first")] if lags else []),
    )
    per_slice = base.groupBy(*by).agg(
        *[F.sum(c).alias(f"_t_{n}") for n, c in {**sums, **totals}.items()],
        *[F.max_by(c, at).alias(f"_t_{n}") for n, c in lags.items()],
        *[F.max_by(c, F.when(c.isNotNull(), at)).alias(f"_t_{n}") for n, c in lasts.items()],
    )
    over_slices = Window.partitionBy(*keys).orderBy(SLICE)
    before = over_slices.rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(
        *by,
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums],
        *[F.lag(f"_t_{n}").over(over_slices).alias(f"_c_{n}") for n in lags],
        *[F.last(f"_t_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in lasts],
        *[F.sum(f"_t_{n}").over(Window.partitionBy(*keys)).alias(n) for n in totals],
    )
    joined = rows.join(carried, by)
    out = [c for c in df.columns]
    return joined.select(
        *out,
        *[(F.col(n) + F.col(f"_c_{n}")).alias(n) for n in sums],
        *[F.when(F.col("_first") == 1, F.col(f"_c_{n}")).otherwise(F.col(n)).alias(n) for n in lags],
        *[F.coalesce(F.col(n), F.col(f"_c_{n}")).alias(n) for n in lasts],
        *totals,
    )


def row_numbers(df: DataFrame, keys: list[str], slice_by: Column, order: list[Column], name: str = "rn") -> DataFrame:
    return ordered_scan(df, keys, slice_by, order, sums={name: F.lit(1).cast("bigint")})


def deal_ranges(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """A stage table with RANGE: the rows dealt out in ranges of keys and order with about equally many rows each. A hot key spans
    several ranges, and there are as many ranges as shuffle partitions, however many rows there are."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(parts, *[F.col(k) for k in keys], *order).withColumn(RANGE, F.spark_partition_id()))


def ranged_scan(df: DataFrame, keys: list[str], order: list[Column], **columns: dict[str, Column]) -> DataFrame:
    """`ordered_scan` for an order without a natural slice: ranges of equal size are its slices. The input is read once."""
    return ordered_scan(deal_ranges(df, keys, order), keys, F.col(RANGE), order, **columns).select(
        *df.columns, *[name for some in columns.values() for name in some])


def ranged_row_numbers(df: DataFrame, keys: list[str], order: list[Column], name: str = "rn") -> DataFrame:
    """Add the row number (from 0) within each key."""
    out = ranged_scan(df, keys, order, sums={name: F.lit(1).cast("bigint")})
    return out.withColumn(name, F.col(name) - 1)

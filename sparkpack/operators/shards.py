"""Shard maps: ranges from end keys and range / as-of lookups."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.functions.keys import KEY_DIGITS
from sparkpack.operators.scan import ordered_scan, time_slice
from sparkpack.operators.stage import materialize

PREFIX_DIGITS = 3          # 39-digit keys start with 000..340
UNKNOWN_SHARD = -1
#: Shards of one cell of an index, from which on the cell is split.
CELL_SHARDS = 8


def key_bucket(key: Column, digits: int = PREFIX_DIGITS) -> Column:
    return F.substring(key, 1, digits).cast("int")


def shard_ranges(shard_map: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(start_key, end_key] of each open shard from the end keys alone; the first start is null.

    The order is scanned per key prefix, and only one row per prefix is carried across prefixes.
    """
    by = by or []
    b = "_prefix"
    m = shard_map.withColumn(b, key_bucket(F.col("end_key")))
    inner = Window.partitionBy(*by, b).orderBy("end_key")
    tops = m.groupBy(*by, b).agg(F.max("end_key").alias("_top"))
    over = Window.partitionBy(*(by or [F.lit(0)])).orderBy(b)    # at most 341 rows per map
    carried = tops.select(*by, b, F.lag("_top").over(over).alias("_carry"))
    return (
        m.withColumn("_prev", F.lag("end_key").over(inner))
        .join(carried, by + [b])
        .select(*shard_map.columns, F.coalesce("_prev", "_carry").alias("start_key"))
    )


def _by_bucket(ranges: DataFrame, digits: int) -> DataFrame:
    """One row per key prefix a range touches, so that the range test becomes an equi-join on the prefix."""
    first = F.coalesce(key_bucket(F.col("start_key"), digits), F.lit(0))
    return ranges.withColumn("_bucket", F.explode(F.sequence(first, key_bucket(F.col("end_key"), digits))))


def shard_lookup(records: DataFrame, ranges: DataFrame, on: list[str] | None = None, digits: int = PREFIX_DIGITS) -> DataFrame:
    """First shard whose end key is not below the record's hash key; -1 if the map has none.

    `ranges` comes from `shard_ranges`. No join hint is given: Spark broadcasts the map only if its
    measured size is below the session's threshold, otherwise it sort-merges (and AQE splits hot prefixes).
    """
    on = on or []
    r = _by_bucket(ranges, digits).select(
        *[F.col(c).alias(f"_m_{c}") for c in on], "_bucket", F.col("start_key").alias("_start"),
        F.col("end_key").alias("_end"), F.col("shard_no").alias("_shard"))
    left = records.withColumn("_key_bucket", key_bucket(F.col("hash_key"), digits))
    cond = (F.col("_key_bucket") == F.col("_bucket")) & (F.col("hash_key") <= F.col("_end")) & (
        F.col("_start").isNull() | (F.col("hash_key") > F.col("_start")))
    for c in on:
        cond = cond & (F.col(c) == F.col(f"_m_{c}"))
    return left.join(r, cond, "left").select(
        *records.columns, F.coalesce("_shard", F.lit(UNKNOWN_SHARD).cast("bigint")).alias("shard_no"))


@dataclass(frozen=True)
class ShardIndex:
    """A map cut into key prefixes, longer where its shards lie close together.

    cells: (on..., _cell, start_key, end_key, shard_no), one row per cell a range touches; splits: per length in digits the
    prefixes of that length (on..., _cell) that were cut further.
    """
    cells: DataFrame
    splits: list[tuple[int, DataFrame]]
    on: list[str]


def shard_index(ranges: DataFrame, on: list[str] | None = None, most: int = CELL_SHARDS) -> ShardIndex:
    """Cut the key space like a radix tree: prefixes with more than `most` shards are cut into the prefixes of three more digits.

    `ranges` comes from `shard_ranges`. A cell is cut only if it is dense, so there are at most 1,000 rows for each dense cell
    besides one per shard and level, however unevenly the shards lie. Each level is a stage table; digits bound the levels.
    """
    on = on or []
    step, places = PREFIX_DIGITS, 10**PREFIX_DIGITS
    own = ranges.select(*on, "start_key", "end_key", "shard_no")
    first = F.coalesce(key_bucket(F.col("start_key")), F.lit(0))
    level = materialize(own.withColumn("_cell", F.explode(F.transform(
        F.sequence(first, key_bucket(F.col("end_key"))), lambda n: F.lpad(n.cast("string"), step, "0")))))
    done, splits, digits = None, [], step
    while True:
        dense = materialize(level.groupBy(*on, "_cell").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).drop("_n"))
        if digits + step > KEY_DIGITS or dense.isEmpty():
            return ShardIndex(level if done is None else done.unionByName(level), splits, on)
        splits.append((digits, dense))
        leaves = level.join(dense, [*on, "_cell"], "left_anti")
        done = leaves if done is None else done.unionByName(leaves)
        # the next digits of a range inside its cell; it may begin before the cell and end behind it
        part = lambda c: F.substring(c, digits + 1, step).cast("int")  # noqa: B023, E731
        inside = lambda c: F.substring(c, 1, digits) == F.col("_cell")  # noqa: B023, E731
        low = F.when(inside("start_key"), part("start_key")).otherwise(0)
        high = F.when(inside("end_key"), part("end_key")).otherwise(places - 1)
        level = materialize(level.join(dense, [*on, "_cell"], "left_semi").withColumn("_next", F.explode(F.sequence(low, high))).select(
            *on, F.concat("_cell", F.lpad(F.col("_next").cast("string"), step, "0")).alias("_cell"), "start_key", "end_key", "shard_no"))
        digits += step


def shard_lookup_index(records: DataFrame, index: ShardIndex) -> DataFrame:
    """As `shard_lookup`, with few candidates per record whatever the map looks like: a record's prefix grows while it names a
    cell that was split, then it meets the shards of its cell."""
    records_at = records.withColumn("_at", F.substring("hash_key", 1, PREFIX_DIGITS))
    for digits, dense in index.splits:
        longer = dense.select(*[F.col(c).alias(f"_m_{c}") for c in index.on], F.col("_cell").alias("_m_cell"), F.lit(True).alias("_split"))
        cond = F.col("_at") == F.col("_m_cell")
        for c in index.on:
            cond = cond & (F.col(c) == F.col(f"_m_{c}"))
        joined = records_at.join(longer, cond, "left")
        at = F.when(F.col("_split"), F.substring("hash_key", 1, digits + PREFIX_DIGITS)).otherwise(F.col("_at"))
        records_at = joined.withColumn("_at", at).select(*records.columns, "_at")
    cells = index.cells.select(*[F.col(c).alias(f"_m_{c}") for c in index.on], F.col("_cell").alias("_m_cell"), F.col("start_key").alias("_start"),
                               F.col("end_key").alias("_end"), F.col("shard_no").alias("_shard"))
    cond = (F.col("_at") == F.col("_m_cell")) & (F.col("hash_key") <= F.col("_end")) & (F.col("_start").isNull() | (F.col("hash_key") > F.col("_start")))
    for c in index.on:
        cond = cond & (F.col(c) == F.col(f"_m_{c}"))
    return records_at.join(cells, cond, "left").select(
        *records.columns, F.coalesce("_shard", F.lit(UNKNOWN_SHARD).cast("bigint")).alias("shard_no"))


def shard_lookup_or_alone(records: DataFrame, ranges: DataFrame | None, aggregation_enabled: bool = True) -> DataFrame:
    """Without a usable map, or with packing switched off, every record has shard -1 and travels alone."""
    if ranges is None or not aggregation_enabled:
        return records.withColumns({"shard_no": F.lit(UNKNOWN_SHARD).cast("bigint"), "alone": F.lit(True)})
    found = shard_lookup(records, ranges)
    return found.withColumn("alone", F.col("shard_no") == UNKNOWN_SHARD)


def shard_lookup_asof(records: DataFrame, versions: DataFrame, slice_ms: int = 3_600_000) -> DataFrame:
    """Lookup in the map version that was valid when the record arrived. Every version covers [valid_from, next valid_from).

    Records and the times of refreshes are united in order of time and the last refresh is carried along, so a record meets
    the shards of its own version only, however often the map changed.
    """
    rows = records.withColumns({"_when": F.col("arrival_ts"), "_mark": F.lit(False)})
    marks = versions.select(F.col("valid_from").alias("_when"), F.lit(True).alias("_mark")).distinct()
    carried = ordered_scan(rows.unionByName(marks, allowMissingColumns=True), [], time_slice(F.col("_when"), slice_ms), [F.col("_when"), ~F.col("_mark")],
                           lasts={"_version": F.when(F.col("_mark"), F.col("_when"))})
    ranges = shard_ranges(versions.withColumnRenamed("valid_from", "_version"), ["_version"])
    found = shard_lookup(carried.filter("NOT _mark").drop("_when", "_mark"), ranges, on=["_version"])
    return found.drop("_version")

"""Metric names, levels, granularities and units."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: (metric name, level, unit)
METRICS = [
    ("Test", "detailed", "Count"),
    ("UserRecordsReceived", "detailed", "Count"),
    ("UserRecordsPending", "detailed", "Count"),
    ("UserRecordsPut", "summary", "Count"),
    ("UserRecordsDataPut", "detailed", "Bytes"),
    ("KinesisRecordsPut", "summary", "Count"),
    ("KinesisRecordsDataPut", "detailed", "Bytes"),
    ("ErrorsByCode", "summary", "Count"),
    ("AllErrors", "summary", "Count"),
    ("RetriesPerRecord", "detailed", "Count"),
    ("UserRecordExpired", "summary", "Count"),
    ("BufferingTime", "summary", "Milliseconds"),
    ("RequestTime", "detailed", "Milliseconds"),
    ("UserRecordsPerKinesisRecord", "detailed", "Count"),
    ("KinesisRecordsPerPutRecordsRequest", "detailed", "Count"),
    ("UserRecordsPerPutRecordsRequest", "detailed", "Count"),
]
LEVELS = {"none": 0, "summary": 1, "detailed": 2}
GRANULARITIES = {"global": 0, "stream": 1, "shard": 2}
METRIC_NAME, ERROR_CODE, STREAM_NAME, SHARD_ID = "MetricName", "ErrorCode", "StreamName", "ShardId"


def _ranked(text: Column, ranks: dict[str, int], what: str) -> Column:
    lowered = F.lower(text)
    out = None
    for name, rank in ranks.items():
        out = F.when(lowered == name, rank) if out is None else out.when(lowered == name, rank)
    return out.otherwise(F.raise_error(F.concat(F.lit(f"unknown metric {what} "), F.coalesce(text, F.lit("null")))).cast("int"))


def level_rank(text: Column) -> Column:
    return _ranked(text, LEVELS, "level")


def granularity_rank(text: Column) -> Column:
    return _ranked(text, GRANULARITIES, "granularity")


def _by_name(name: Column, index: int, default: str) -> Column:
    pairs = [F.lit(x) for row in METRICS for x in (row[0], row[index])]
    return F.coalesce(F.element_at(F.create_map(*pairs), name), F.lit(default))


def metric_level(name: Column) -> Column:
    """Level name of a metric; metrics the table does not know are detailed."""
    return _by_name(name, 1, "detailed")


def metric_unit(name: Column) -> Column:
    return _by_name(name, 2, "None")


def dimension_key(dims: Column) -> Column:
    """Canonical text of an ordered dimension array: NUL key SOH value, repeated."""
    part = lambda d: F.concat(F.lit("\0"), d["key"], F.lit("\1"), d["value"])
    return F.array_join(F.transform(dims, part), "")


def last_dimension(dims: Column) -> Column:
    return F.element_at(dims, -1)


def without_last(dims: Column) -> Column:
    return F.slice(dims, F.lit(1), F.greatest(F.size(dims) - 1, F.lit(0)))


def dimension(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))


def metric_dimensions(name: Column, error_code: Column, stream: Column, shard: Column) -> Column:
    """Name, error code, stream, shard in builder order; absent parts are left out."""
    parts = F.array(
        dimension(METRIC_NAME, name), dimension(ERROR_CODE, error_code),
        dimension(STREAM_NAME, stream), dimension(SHARD_ID, shard),
    )
    return F.filter(parts, lambda d: d["value"].isNotNull())


def dims_text(dims: Column) -> Column:
    """Readable `key=value,...` form for reports."""
    return F.array_join(F.transform(dims, lambda d: F.concat(d["key"], F.lit("="), d["value"])), ",")

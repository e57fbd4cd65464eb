"""Delivery metrics: totals, one-second partials, trailing windows and dimension-prefix rollups.

All statistics are mergeable (count, sum, min, max), so every step is a map-side combined hash aggregate.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.functions import metric_names as M
from sparkpack.functions.text import ms_between
from sparkpack.operators.scan import ordered_scan
from sparkpack.operators.segments import cut_batches

STATS = ["count", "sum", "min", "max"]


def sample_stats(value: Column) -> list[Column]:
    return [F.count(value).alias("count"), F.sum(value).alias("sum"), F.min(value).alias("min"), F.max(value).alias("max")]


def merge_stats() -> list[Column]:
    return [F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max")]


def second_of(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(1_000_000)).cast("bigint")


def metric_totals(samples: DataFrame, by: list[str] | None = None) -> DataFrame:
    return samples.groupBy(*(by or ["dims"])).agg(*sample_stats(F.col("value")))


def metric_per_second(samples: DataFrame) -> DataFrame:
    return samples.groupBy("dims", second_of(F.col("ts")).alias("second")).agg(*sample_stats(F.col("value")))


def trailing_filter(second: Column, as_of_s: int, window_s: int) -> Column:
    return (second > as_of_s - window_s) & (second <= as_of_s)


def metric_trailing(per_second: DataFrame, as_of_s: int, window_s: int = 60) -> DataFrame:
    """Merge the one-second partials that are newer than `as_of - window`."""
    return per_second.filter(trailing_filter(F.col("second"), as_of_s, window_s)).groupBy("dims").agg(*merge_stats())


def metric_trailing_each(per_second: DataFrame, window_s: int = 60, slice_s: int = 3600) -> DataFrame:
    """Trailing statistics at every second that has samples.

    A metric's seconds are cut into slices; the last `window - 1` seconds of a slice are repeated in the next
    one, so each window is complete inside its slice and no metric is a single task.
    """
    own = F.floor(F.col("second") / slice_s).cast("bigint")
    last = F.floor((F.col("second") + (window_s - 1)) / slice_s).cast("bigint")
    cut = per_second.withColumn("_own", own).withColumn("_slice", F.explode(F.sequence(own, last)))
    w = Window.partitionBy("dims", "_slice").orderBy("second").rangeBetween(-(window_s - 1), 0)
    agg = {"count": F.sum("count"), "sum": F.sum("sum"), "min": F.min("min"), "max": F.max("max")}
    return cut.select("dims", "second", "_own", "_slice", *[c.over(w).alias(n) for n, c in agg.items()]).filter(
        "_own = _slice").drop("_own", "_slice")


def metric_rollup(partials: DataFrame, also: list[str] | None = None) -> DataFrame:
    """Merge full-dimension partials into every dimension prefix (name, [error code], stream, shard).

    The input is already aggregated, so the expansion works on metrics, not on samples.
    """
    prefixes = F.transform(F.sequence(F.lit(1), F.size("dims")), lambda n: F.slice("dims", F.lit(1), n))
    return (
        partials.select(F.explode(prefixes).alias("dims"), *(also or []), *STATS)
        .groupBy("dims", *(also or [])).agg(*merge_stats())
    )


def metric_granularity(dims: Column) -> Column:
    keys = F.transform(dims, lambda x: x["key"])
    return F.when(F.array_contains(keys, M.SHARD_ID), 2).when(F.array_contains(keys, M.STREAM_NAME), 1).otherwise(0)


def metric_filter(metrics: DataFrame, max_level: str, max_granularity: str) -> DataFrame:
    """Metrics at or below the configured level and granularity; the first dimension must be the name."""
    first = F.element_at("dims", 1)
    level = M.level_rank(M.metric_level(first["value"]))
    keep = (
        (M.level_rank(F.lit(max_level)) > 0) & (first["key"] == M.METRIC_NAME)
        & (level <= M.level_rank(F.lit(max_level)))
        & (metric_granularity(F.col("dims")) <= M.granularity_rank(F.lit(max_granularity)))
    )
    return metrics.filter((F.size("dims") > 0) & keep)


def metric_by_name(metrics: DataFrame, name: str | None) -> DataFrame:
    return metrics if not name else metrics.filter(F.element_at("dims", 1)["value"] == name)


def extra_dimensions(samples: DataFrame, extras: list[tuple[str, str, str]]) -> DataFrame:
    """Insert configured (key, value, granularity) dimensions: global ones after the name and error code,
    stream ones after the stream, shard ones after the shard."""
    def at(level: str) -> list[Column]:
        return [M.dimension(k, F.lit(v)) for k, v, g in extras if g == level]

    def part(key: str, level: str) -> Column:
        own = F.filter("dims", lambda x: x["key"] == key)
        return F.when(F.size(own) > 0, F.concat(own, F.array(*at(level)))).otherwise(own) if at(level) else own

    head = F.filter("dims", lambda x: x["key"].isin(M.METRIC_NAME, M.ERROR_CODE))
    if at("global"):
        head = F.concat(head, F.array(*at("global")))
    return samples.withColumn("dims", F.concat(head, part(M.STREAM_NAME, "stream"), part(M.SHARD_ID, "shard")))


def metric_elapsed(samples: DataFrame, as_of: Column) -> DataFrame:
    return samples.groupBy("dims").agg(F.min("ts").alias("first_ts")).withColumn(
        "elapsed_s", (F.unix_micros(as_of) - F.unix_micros("first_ts")) / 1_000_000.0)


def metrics_response(metrics: DataFrame, seconds: Column) -> DataFrame:
    """Answer rows: name, dimensions without the name, statistics, seconds covered."""
    return metrics.select(
        F.element_at("dims", 1)["value"].alias("name"),
        F.slice("dims", F.lit(2), F.greatest(F.size("dims") - 1, F.lit(0))).alias("dims"),
        *STATS, (F.col("sum") / F.col("count")).alias("mean"), seconds.alias("seconds"))


def metric_datums(metrics: DataFrame) -> DataFrame:
    """Upload rows: the name leaves the dimensions, the unit comes with the name."""
    name = F.element_at("dims", 1)["value"]
    return metrics.withColumns({
        "name": name, "unit": M.metric_unit(name), "dims": F.filter("dims", lambda x: x["key"] != M.METRIC_NAME)})


#: Bytes an upload text spends on a metric's statistics, and on each dimension besides its key and value.
DATUM_BYTES, DIMENSION_BYTES = 256, 64
#: An upload stays below 39 KiB.
UPLOAD_BYTES = 39 * 1024 - 1


def upload_size(dims: Column) -> Column:
    return (F.octet_length(M.dims_text(dims)) + F.size(dims) * DIMENSION_BYTES + DATUM_BYTES).cast("bigint")


def metric_batches(metrics: DataFrame, batch_size: int = 20, batch_bytes: int = UPLOAD_BYTES) -> DataFrame:
    """Upload batches in order of dimension count, then dimensions, bounded in rows and in bytes; a metric above the byte bound
    travels alone."""
    m = metrics.withColumns({"n_dims": F.size("dims"), "dims_text": M.dims_text(F.col("dims")), "upload_bytes": upload_size(F.col("dims"))})
    return cut_batches(m, [F.col("n_dims"), F.col("dims_text")], F.col("upload_bytes"), batch_size, batch_bytes)


def error_counts(attempts: DataFrame) -> DataFrame:
    """AllErrors (0 for successes) and ErrorsByCode per stream and shard."""
    samples = F.array_compact(F.array(
        F.struct(F.lit("AllErrors").alias("name"), F.lit(None).cast("string").alias("code"),
                 F.when(F.col("success"), 0.0).otherwise(1.0).alias("value")),
        F.when(~F.col("success"), F.struct(F.lit("ErrorsByCode").alias("name"), F.col("error_code").alias("code"),
                                            F.lit(1.0).alias("value"))),
    ))
    return attempts.select("stream_name", "shard_no", F.explode(samples).alias("s")).groupBy(
        "stream_name", "shard_no", F.col("s.name").alias("name"), F.col("s.code").alias("error_code")
    ).agg(*sample_stats(F.col("s.value")))


def delivery_samples(final: DataFrame) -> DataFrame:
    """Samples one finished record contributes."""
    ok = F.col("success")
    def s(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"))
    samples = F.array_compact(F.array(
        s("UserRecordsPut", F.when(ok, 1).otherwise(0)),
        F.when(ok, s("UserRecordsDataPut", F.col("data_bytes"))),
        F.when(~ok & (F.col("error_code") == "Expired"), s("UserRecordExpired", F.lit(1))),
        s("RetriesPerRecord", F.col("attempt_no") - 1),
    ))
    return final.select("stream_name", "shard_no", F.explode(samples).alias("s")).select("stream_name", "shard_no", "s.*")


def buffering_time(attempts: DataFrame) -> DataFrame:
    """Milliseconds each attempt waited since arrival or since the previous attempt."""
    w = Window.partitionBy("source_id").orderBy("attempt_no")
    return attempts.withColumn(
        "value", ms_between(F.coalesce(F.lag("end_ts").over(w), F.col("arrival_ts")), F.col("start_ts")))


def packing_metrics(entries: DataFrame, requests: DataFrame) -> DataFrame:
    """How many records went into each entry and request, and how long requests took."""
    per_request = entries.groupBy("request_id").agg(
        F.count(F.lit(1)).cast("double").alias("entries"), F.sum("n_members").cast("double").alias("members"))
    both = per_request.join(requests, "request_id")
    def s(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))
    of_requests = both.select(F.explode(F.array(
        s("KinesisRecordsPerPutRecordsRequest", F.col("entries")),
        s("UserRecordsPerPutRecordsRequest", F.col("members")),
        s("RequestTime", ms_between(F.col("start_ts"), F.col("end_ts"))),
    )).alias("s")).select("s.*")
    of_entries = entries.select(F.lit("UserRecordsPerKinesisRecord").alias("name"), F.col("n_members").cast("double").alias("value"))
    return of_requests.unionByName(of_entries).groupBy("name").agg(*sample_stats(F.col("value")))


def shard_put_metrics(matched: DataFrame) -> DataFrame:
    """Stored and refused entries and stored bytes per shard, for requests answered entry by entry."""
    ok = F.col("sequence_number").isNotNull()
    return matched.filter((F.col("action") == "per_record") & ~F.col("mismatch")).groupBy("predicted_shard").agg(
        F.count(F.lit(1)).alias("entries"), F.count_if(ok).alias("stored"),
        F.coalesce(F.sum(F.when(ok, F.col("data_bytes"))), F.lit(0)).alias("stored_bytes"))


def pending_gauge(records: DataFrame, finished: DataFrame, tick_ms: int = 200, slice_ticks: int = 18_000) -> DataFrame:
    """Received minus finished records per stream at each tick that saw a change."""
    def ticks(df: DataFrame, ts: str, step: int) -> DataFrame:
        return df.select("stream_name", F.floor(F.unix_micros(ts) / (tick_ms * 1000)).cast("bigint").alias("tick"),
                         F.lit(step).cast("bigint").alias("step"))
    changes = ticks(records, "arrival_ts", 1).unionByName(ticks(finished, "finished_ts", -1)).groupBy(
        "stream_name", "tick").agg(F.sum("step").alias("step"))
    cut = F.floor(F.col("tick") / slice_ticks).cast("bigint")
    return ordered_scan(changes, ["stream_name"], cut, [F.col("tick")], sums={"pending": F.col("step")}).drop("step")


def progress_counts(results: DataFrame) -> DataFrame:
    first = F.min_by("sequence_number", F.when(F.col("success"), F.struct("finished_ts", "source_id")))
    return results.agg(
        F.count_if("success").alias("n_success"), F.count_if(~F.col("success")).alias("n_error"),
        first.alias("first_sequence_number"))

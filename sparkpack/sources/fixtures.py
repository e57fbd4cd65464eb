"""Typed inputs derived from the `events` and `documents` tables.

Each function is a lazy DataFrame over the parquet table, so its work grows with the table. The same
derivations exist as SQL views in `sparkpack/plans/oracle.py`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpack.config import PackConfig
from sparkpack.functions import keys as K
from sparkpack.functions.metric_names import metric_dimensions
from sparkpack.functions.text import plus_ms
from sparkpack.operators import intake, shards
from sparkpack.operators.scan import row_numbers, time_slice
from sparkpack.operators.stage import materialize
from sparkpack.sources.scans import read_table

HOUR = 3_600_000
# event time of the test tables spans 30 days, so the delivery defaults are scaled
SCALED = PackConfig(
    record_max_buffered_ms=6 * HOUR, record_ttl_ms=24 * HOUR,
    aggregation_max_size=500, aggregation_max_count=20,
    collection_max_count=20, collection_max_size=5_000, shard_burst_size=1_000,
    shard_records_per_sec=5.0, shard_bytes_per_sec=50.0,
    slice_ms=HOUR, block_cost=16_000, block_ms=48 * HOUR,
)
ISLAND_GAP_MS = 3 * HOUR
RECORD_CAPACITY, RECORD_RATE, EXPIRY_RATE = 5.0, 0.0003, 0.0002
BYTE_CAPACITY, BYTE_RATE = 50.0, 0.0025

# fixed values: open shards of the sample map as (shard number, last hash key)
THREE_SHARDS = [
    (2, "085070591730234615865843651857942052862"),
    (3, "170141183460469231731687303715884105727"),
    (1, "340282366920938463463374607431768211455"),
]
# the same ranges after a refresh
SHARD_VERSIONS = [
    ("2024-01-01 00:00:00", 0),
    ("2024-01-16 00:00:00", 1),
]
REFRESHED = {2: 5, 3: 6, 1: 7}


def events(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def user_records(spark: SparkSession, d: str) -> DataFrame:
    return records_from_events(events(spark, d))


def records_from_events(ev: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    explicit = F.concat(
        (F.lit(1) + F.expr("event_id div 10") % 33).cast("string"),
        F.lit("0" * 30), F.lpad(eid.cast("string"), 7, "0"),
    )
    return ev.select(
        eid.alias("source_id"),
        F.col("event_type").alias("stream_name"),
        F.col("user_id").cast("string").alias("partition_key"),
        F.when(eid % 10 == 0, explicit).alias("explicit_hash_key"),
        F.col("props").cast("binary").alias("data"),
        F.col("ts").alias("arrival_ts"),
    )


def dirty_records(spark: SparkSession, d: str) -> DataFrame:
    r, sid = user_records(spark, d), F.col("source_id")
    return r.select(
        "source_id",
        F.when(sid % 97 == 0, F.lit("  ")).otherwise(F.col("stream_name")).alias("stream_name"),
        F.when(sid % 97 == 0, F.col("partition_key")).when(sid % 89 == 0, F.lit(None))
        .when(sid % 83 == 0, F.lit("k" * 257)).otherwise(F.col("partition_key")).alias("partition_key"),
        F.when((sid % 79 == 0), F.lit("abc"))
        .when((sid % 73 == 0), F.lit(str(2**128))).otherwise(F.col("explicit_hash_key")).alias("explicit_hash_key"),
        F.when(sid % 5000 == 1, F.repeat(F.lit("x"), F.lit(1_048_577)).cast("binary"))
        .otherwise(F.col("data")).alias("data"),
        "arrival_ts",
    )


def document_records(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select(
        F.col("doc_id").alias("source_id"),
        F.col("source").alias("stream_name"),
        F.col("lang").alias("partition_key"),
        F.lit(None).cast("string").alias("explicit_hash_key"),
        F.col("text").cast("binary").alias("data"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id")).alias("arrival_ts"),
    )


def values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """Literal rows as a local relation, so their size is known to the optimizer."""
    body = ", ".join("(" + ", ".join(repr(v) if v is not None else "NULL" for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def three_shards(spark: SparkSession) -> DataFrame:
    return values(spark, THREE_SHARDS, "shard_no, end_key").select(F.col("shard_no").cast("bigint"), "end_key")


def shard_versions(spark: SparkSession) -> DataFrame:
    rows = [(since, (no if v == 0 else REFRESHED[no]), end) for since, v in SHARD_VERSIONS for no, end in THREE_SHARDS]
    return values(spark, rows, "valid_from, shard_no, end_key").select(
        F.col("valid_from").cast("timestamp"), F.col("shard_no").cast("bigint"), "end_key")


def keyed(records: DataFrame) -> DataFrame:
    return records.withColumn("hash_key", K.effective_hash_key(F.col("explicit_hash_key"), F.col("partition_key")))


def routed(records: DataFrame, cfg: PackConfig = SCALED) -> DataFrame:
    """Put records with times, hash key and predicted shard."""
    spark = records.sparkSession
    return shards.shard_lookup(keyed(intake.assign_times(records, cfg)), shards.shard_ranges(three_shards(spark)))


def routed_records(spark: SparkSession, d: str, cfg: PackConfig = SCALED) -> DataFrame:
    return routed(user_records(spark, d), cfg)


def routed_table(spark: SparkSession, d: str) -> DataFrame:
    """Routed records as a stage table: ordered scans read their input twice, the hash keys are computed once."""
    return materialize(routed_records(spark, d))


def stream_shards(spark: SparkSession, d: str) -> DataFrame:
    """A shard map per stream: one shard ends at each user's key, one last shard closes the key space."""
    users = events(spark, d).select("event_type", "user_id").distinct()
    own = users.select(
        F.col("event_type").alias("stream_name"),
        F.floor(F.col("user_id") / 10).cast("bigint").alias("page_no"),
        (F.col("user_id") + 1).alias("shard_no"),
        K.hash_key(F.col("user_id").cast("string")).alias("end_key"),
        (F.col("user_id") % 7 == 0).alias("closed"),
    )
    last = users.select(F.col("event_type").alias("stream_name")).distinct().select(
        "stream_name", F.lit(-1).cast("bigint").alias("page_no"), F.lit(0).cast("bigint").alias("shard_no"),
        F.lit(K.MAX_HASH_KEY).alias("end_key"), F.lit(False).alias("closed"),
    )
    return own.unionByName(last)


def shard_pages(spark: SparkSession, d: str) -> DataFrame:
    """Stream descriptions as JSON text, one row per page of at most ten shards."""
    shard = F.struct(
        K.shard_name(F.col("shard_no")).alias("ShardId"),
        F.struct(K.strip_zeros(F.col("end_key")).alias("EndingHashKey")).alias("HashKeyRange"),
        F.struct(
            F.lit("49").alias("StartingSequenceNumber"),
            F.when(F.col("closed"), F.lit("50")).alias("EndingSequenceNumber"),
        ).alias("SequenceNumberRange"),
    )
    page = F.col("page_no")
    status = F.when(page % 6 == 5, "CREATING").when(page % 2 == 0, "ACTIVE").otherwise("UPDATING")
    return (
        stream_shards(spark, d).groupBy("stream_name", "page_no").agg(F.collect_list(shard).alias("Shards"))
        .select(
            "stream_name", "page_no",
            F.to_json(F.struct(F.struct(
                F.col("stream_name").alias("StreamName"), status.alias("StreamStatus"), "Shards",
                (page >= 0).alias("HasMoreShards"),
            ).alias("StreamDescription"))).alias("body"),
        )
    )


# fixed values: service error codes
THROTTLED = "ProvisionedThroughputExceededException"


def request_members(spark: SparkSession, d: str) -> DataFrame:
    """User records inside request entries: two members per entry, fifty entries per request."""
    ev = events(spark, d)
    return ev.select(
        F.col("event_id").alias("source_id"),
        F.col("event_type").alias("stream_name"),
        F.expr("event_id div 2").alias("entry_id"),
        F.expr("event_id div 100").alias("request_id"),
        F.expr("(event_id div 2) % 50").alias("pos"),
        (F.lit(1) + F.expr("event_id div 2") % 3).alias("predicted_shard"),
        F.octet_length("props").cast("bigint").alias("data_bytes"),
        F.col("ts").alias("arrival_ts"),
        plus_ms(F.col("ts"), 3 * HOUR).alias("expiration_ts"),
    )


def requests(spark: SparkSession, d: str) -> DataFrame:
    rid = F.col("request_id")
    transport = rid % 31 == 0
    start = plus_ms(F.max("arrival_ts"), 1000)
    return (
        request_members(spark, d).groupBy("request_id")
        .agg(start.alias("start_ts"), F.countDistinct("pos").alias("n_entries"))
        .select(
            "request_id", "n_entries", transport.alias("transport_error"),
            F.when(transport, F.lit(None)).when(rid % 29 == 0, 400).when(rid % 23 == 0, 503).otherwise(200)
            .cast("int").alias("status"),
            F.when(transport, F.lit("connection reset by peer")).alias("error_text"),
            "start_ts", plus_ms(F.col("start_ts"), F.lit(10) + rid % 90).alias("end_ts"),
        )
    )


def request_entries(spark: SparkSession, d: str) -> DataFrame:
    return request_members(spark, d).groupBy("request_id", "pos", "entry_id", "predicted_shard").agg(
        F.sum("data_bytes").alias("data_bytes"), F.count(F.lit(1)).alias("n_members"))


def responses(spark: SparkSession, d: str) -> DataFrame:
    """Response entries of the requests that were answered with status 200."""
    e, rid, code = F.col("entry_id"), F.col("request_id"), F.col("entry_id") % 20
    entries = request_entries(spark, d)
    answered = (rid % 31 != 0) & (rid % 29 != 0) & (rid % 23 != 0)
    dropped = (rid % 17 == 0) & (F.col("pos") == 49)
    error = (
        F.when(code == 0, THROTTLED).when(code == 1, "InternalFailure").when(code == 2, "ServiceUnavailable")
        .when(code == 3, "xx")
    )
    return entries.filter(answered & ~dropped).select(
        "request_id", "pos",
        F.when(error.isNull(), F.concat(F.lit("4957"), F.lpad(e.cast("string"), 52, "0"))).alias("sequence_number"),
        F.when(error.isNull(), K.shard_name(
            F.when(e % 50 == 7, F.lit(1) + (e + 1) % 3).otherwise(F.col("predicted_shard")))).alias("shard_id"),
        error.alias("error_code"),
        F.when(error.isNotNull(), F.concat(F.lit("entry "), e.cast("string"))).alias("error_message"),
    )


def response_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Responses as JSON text, one row per request (at most fifty entries)."""
    entry = F.struct(
        "pos", F.col("sequence_number").alias("SequenceNumber"), F.col("shard_id").alias("ShardId"),
        F.col("error_code").alias("ErrorCode"), F.col("error_message").alias("ErrorMessage"),
    )
    body = F.to_json(F.struct(F.transform("e", lambda x: x.dropFields("pos")).alias("Records")))
    return (
        responses(spark, d).groupBy("request_id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
        .select("request_id", body.alias("body"))
    )


# fixed values: error codes of failed attempts
ATTEMPT_CODES = [THROTTLED, "InternalFailure", "ServiceUnavailable", "Expired"]


def attempts(spark: SparkSession, d: str) -> DataFrame:
    """One row per delivery attempt, one to three per record."""
    r = routed_records(spark, d).withColumn("i", F.explode(F.sequence(F.lit(1), (F.lit(1) + F.col("source_id") % 3).cast("int"))))
    sid, i = F.col("source_id"), F.col("i")
    ok = (i == F.lit(1) + sid % 3) & (sid % 11 != 0)
    code = F.element_at(F.array(*[F.lit(c) for c in ATTEMPT_CODES]), ((sid + i) % 4 + 1).cast("int"))
    start = plus_ms(F.col("arrival_ts"), i * 100)
    return r.select(
        "source_id", "stream_name", "shard_no", F.octet_length("data").cast("bigint").alias("data_bytes"), "arrival_ts",
        i.alias("attempt_no"), start.alias("start_ts"),
        plus_ms(start, (F.lit(1) + sid % 7) * 5).alias("end_ts"),
        ok.alias("success"),
        F.when(~ok, code).alias("error_code"),
        F.when(~ok, F.concat(F.lit("failed with "), code)).alias("error_message"),
        F.when(ok, K.shard_name(F.col("shard_no"))).alias("shard_id"),
        F.when(ok, F.concat(F.lit("4957"), F.lpad(sid.cast("string"), 52, "0"))).alias("sequence_number"),
    )


def results_from_events(ev: DataFrame) -> DataFrame:
    """Delivery results: some records have none, some results are duplicates, some belong to no record."""
    eid = F.col("event_id")
    kinds = F.array_compact(F.array(
        F.when(eid % 25 != 0, F.lit(0)), F.when((eid % 60 == 0) & (eid % 25 != 0), F.lit(1)), F.when(eid % 400 == 0, F.lit(2)),
    ))
    return ev.withColumn("kind", F.explode(kinds)).select(
        F.when(F.col("kind") == 2, eid + 10_000_000).otherwise(eid).alias("source_id"),
        ((eid % 11 != 0) & (F.col("kind") == 0)).alias("success"),
        plus_ms(F.col("ts"), (F.lit(1) + eid % 3) * 200 + F.when(F.col("kind") == 1, 1000).otherwise(0)).alias("finished_ts"),
        F.concat(F.lit("4957"), F.lpad(eid.cast("string"), 52, "0")).alias("sequence_number"),
    )


def results(spark: SparkSession, d: str) -> DataFrame:
    return results_from_events(events(spark, d))


# fixed values: metric measured by each event type
SAMPLE_METRIC = {"click": "UserRecordsReceived", "view": "UserRecordsPut", "purchase": "BufferingTime",
                 "signup": "UserRecordsDataPut", "error": "ErrorsByCode"}
DAY_US = 86_400_000_000


def samples_from_events(ev: DataFrame) -> DataFrame:
    """Metric samples, squeezed into three minutes per day so that windows hold several rows."""
    uid, us = F.col("user_id"), F.unix_micros("ts")
    pairs = [F.lit(x) for kv in SAMPLE_METRIC.items() for x in kv]
    name = F.element_at(F.create_map(*pairs), F.col("event_type"))
    error = F.when(F.col("event_type") == "error", F.concat(F.lit("Code"), (uid % 3).cast("string")))
    out = ev.select(
        F.col("event_id").alias("sample_id"),
        name.alias("name"),
        error.alias("error_code"),
        F.concat(F.lit("stream-"), (uid % 4).cast("string")).alias("stream_name"),
        F.when(uid % 9 != 0, K.shard_name(uid % 8)).alias("shard_id"),
        F.col("value"),
        F.timestamp_micros(us - us % DAY_US + F.floor((us % DAY_US) / 480)).alias("ts"),
    )
    return out.withColumn("dims", metric_dimensions(F.col("name"), F.col("error_code"), F.col("stream_name"), F.col("shard_id")))


def metric_samples(spark: SparkSession, d: str) -> DataFrame:
    return samples_from_events(events(spark, d))


def control_rows(spark: SparkSession, d: str) -> DataFrame:
    """Flush commands: every stream at each midnight, and all streams at once on days 10 and 20."""
    days = events(spark, d).select(F.col("event_type").alias("stream_name"), F.date_trunc("day", "ts").alias("flush_ts")).distinct()
    everything = days.filter(F.dayofmonth("flush_ts").isin(10, 20)).select(
        F.lit(None).cast("string").alias("stream_name"), plus_ms(F.col("flush_ts"), 12 * HOUR).alias("flush_ts")).distinct()
    return days.unionByName(everything)


# fixed values: level words of log frames, by event_id % 8 (the last has none)
LOG_LEVELS = ["trace", "debug", "info", "warn", "warning", "error", "fatal"]


def log_lines(spark: SparkSession, d: str) -> DataFrame:
    """Framed log output: numbered lines of two sources, with missing markers and empty frames."""
    eid = F.col("event_id")
    numbered = row_numbers(
        events(spark, d).withColumn("source", F.when(eid % 2 == 0, "StdOut").otherwise("StdErr")),
        ["source"], time_slice(F.col("ts"), SCALED.slice_ms), [F.col("ts"), eid], "event_no")
    level = F.element_at(F.array(*[F.lit(x) for x in LOG_LEVELS], F.lit("none")), (eid % 8 + 1).cast("int"))
    head = F.concat(
        F.when(level == "none", F.lit("")).otherwise(F.concat(level, F.lit(": "))),
        F.lit("[Daemon:"), F.col("user_id").cast("string"), F.lit("] "), F.col("props"))
    lines = F.array(
        F.struct(F.lit(0).alias("k"), F.when(eid % 43 != 0, F.lit("++++")).alias("line")),
        F.struct(F.lit(1).alias("k"), F.when(eid % 47 != 0, head).alias("line")),
        F.struct(F.lit(2).alias("k"), F.when((eid % 3 == 0) & (eid % 47 != 0), F.concat(F.lit("more "), eid.cast("string"))).alias("line")),
        F.struct(F.lit(3).alias("k"), F.when(eid % 41 != 0, F.lit("----")).alias("line")),
    )
    return numbered.select("source", "event_no", F.explode(lines).alias("l")).filter("l.line IS NOT NULL").select(
        "source", (F.col("event_no") * 4 + F.col("l.k")).cast("bigint").alias("line_no"), F.col("l.line").alias("line"))

"""Queries over scans, predicates and shard lookups."""
from __future__ import annotations

from pyspark.sql import functions as F

from sparkpack.operators import intake, shards
from sparkpack.plans.registry import query
from sparkpack.sources import fixtures as fx
from sparkpack.sources import scans

US = F.unix_micros


@query("put_records_scan", """
    SELECT source_id, stream_name, partition_key, explicit_hash_key, hex(data) AS data_hex, epoch_us(arrival_ts) AS arrival_us
    FROM user_records""")
def put_records_scan(spark, d):
    """Put records in their fixed schema."""
    r = scans.put_records_scan(fx.user_records(spark, d))
    return r.select("source_id", "stream_name", "partition_key", "explicit_hash_key",
                    F.hex("data").alias("data_hex"), US("arrival_ts").alias("arrival_us"))


@query("message_route", """
    SELECT event_type AS stream_name,
           CASE event_id % 20 WHEN 0 THEN 'flush' WHEN 1 THEN 'metrics_request' WHEN 2 THEN 'unknown' ELSE 'put' END AS kind,
           count(*) AS n, sum(event_id)::BIGINT AS id_sum
    FROM events GROUP BY 1, 2""")
def message_route(spark, d):
    """Mixed messages split by payload kind."""
    k = F.col("event_id") % 20
    messages = fx.events(spark, d).select(
        "event_id", "event_type",
        F.when(k > 2, F.struct(F.col("user_id").cast("string").alias("partition_key"), F.col("props").alias("data"))).alias("put_record"),
        F.when(k == 0, F.struct(F.col("event_type").alias("stream_name"))).alias("flush"),
        F.when(k == 1, F.struct(F.lit("AllErrors").alias("name"), F.lit(60).alias("seconds"))).alias("metrics_request"))
    return scans.message_route(messages).groupBy(F.col("event_type").alias("stream_name"), "kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query("shard_pages_scan", "SELECT stream_name, shard_no, end_key FROM open_shards")
def shard_pages_scan(spark, d):
    """JSON stream descriptions to open shards."""
    return scans.shard_pages_scan(fx.shard_pages(spark, d))


@query("union_pages", """
    SELECT stream_name, count(*) AS n_shards, min(end_key) AS first_end, max(end_key) AS last_end
    FROM open_shards GROUP BY 1""")
def union_pages(spark, d):
    """First page of a description united with the pages that follow it."""
    pages = fx.shard_pages(spark, d)
    first, rest = pages.filter("page_no = -1"), pages.filter("page_no <> -1")
    return scans.shard_pages_scan(first).unionByName(scans.shard_pages_scan(rest)).groupBy("stream_name").agg(
        F.count(F.lit(1)).alias("n_shards"), F.min("end_key").alias("first_end"), F.max("end_key").alias("last_end"))


@query("sorted_shard_map", "SELECT stream_name, end_key, shard_no FROM open_shards ORDER BY 1, 2")
def sorted_shard_map(spark, d):
    """Open shards by end key."""
    return scans.shard_pages_scan(fx.shard_pages(spark, d)).select("stream_name", "end_key", "shard_no").orderBy("stream_name", "end_key")


@query("shard_ranges", """
    SELECT stream_name, shard_no, lag(end_key) OVER (PARTITION BY stream_name ORDER BY end_key) AS start_key, end_key
    FROM open_shards""")
def shard_ranges(spark, d):
    """Key range of each open shard, from end keys only."""
    m = scans.shard_pages_scan(fx.shard_pages(spark, d))
    return shards.shard_ranges(m, ["stream_name"]).select("stream_name", "shard_no", "start_key", "end_key")


@query("read_after_sequence", f"""
    SELECT shard_no, source_id, '4957' || lpad(source_id::VARCHAR, 52, '0') AS sequence_number,
           (row_number() OVER (PARTITION BY shard_no ORDER BY source_id) - 1) // 1000 AS page
    FROM routed WHERE source_id > 120""")
def read_after_sequence(spark, d):
    """All records of each shard after a sequence number, in pages of a thousand."""
    stored = fx.routed_records(spark, d).withColumn(
        "sequence_number", F.concat(F.lit("4957"), F.lpad(F.col("source_id").cast("string"), 52, "0")))
    after = "4957" + "120".rjust(52, "0")
    return scans.read_on(stored, after).select("shard_no", "source_id", "sequence_number", "page")


@query("parse_put_response", "SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY pos) - 1 AS pos, sequence_number, shard_id, error_code, error_message FROM responses")
def parse_put_response(spark, d):
    """JSON responses to one row per entry."""
    return scans.parse_put_response(fx.response_bodies(spark, d))


@query("validate_records", "SELECT source_id, reject_reason FROM validated")
def validate_records(spark, d):
    """First rule each record breaks, null if none."""
    return intake.validate_records(fx.dirty_records(spark, d)).select("source_id", "reject_reason")


@query("rejects_by_reason", """
    SELECT stream_name, reject_reason, count(*) AS n FROM validated WHERE reject_reason IS NOT NULL GROUP BY 1, 2""")
def rejects_by_reason(spark, d):
    """Rejected records per stream and reason."""
    return intake.rejects_by_reason(fx.dirty_records(spark, d))


@query("assign_times", """
    SELECT source_id, epoch_us(least(arrival_ts + INTERVAL 6 HOUR, arrival_ts + INTERVAL 24 HOUR)) AS deadline_us,
           epoch_us(arrival_ts + INTERVAL 24 HOUR) AS expiration_us FROM user_records""")
def assign_times(spark, d):
    """Deadline and expiration of each record."""
    return intake.assign_times(fx.user_records(spark, d), fx.SCALED).select(
        "source_id", US("deadline_ts").alias("deadline_us"), US("expiration_ts").alias("expiration_us"))


@query("filter_expired", """
    SELECT stream_name, arrival_ts + INTERVAL 24 HOUR < TIMESTAMP '2024-01-16 12:00:00' AS expired, count(*) AS n,
           sum(source_id)::BIGINT AS id_sum
    FROM user_records GROUP BY 1, 2""")
def filter_expired(spark, d):
    """Live and expired records at one moment."""
    timed = intake.assign_times(fx.user_records(spark, d), fx.SCALED)
    return intake.mark_expired(timed, F.lit("2024-01-16 12:00:00").cast("timestamp")).groupBy("stream_name", "expired").agg(
        F.count(F.lit(1)).alias("n"), F.sum("source_id").alias("id_sum"))


@query("hash_key_of_record", "SELECT source_id, hash_key FROM keyed")
def hash_key_of_record(spark, d):
    """Effective hash key of each record."""
    return fx.keyed(fx.user_records(spark, d)).select("source_id", "hash_key")


@query("response_action", """
    SELECT request_id, CASE WHEN transport_error THEN 'retry' WHEN status = 200 THEN 'per_record'
           WHEN status BETWEEN 500 AND 599 THEN 'retry' ELSE 'fail' END AS action FROM requests""")
def response_action(spark, d):
    """What happens to a whole request."""
    return intake.response_action(fx.requests(spark, d)).select("request_id", "action")


@query("retryable_filter", f"""
    SELECT request_id, pos, error_code, error_code <> 'xx' AS retry, error_code IN ('InternalFailure', 'ServiceUnavailable') AS retry_strict
    FROM responses WHERE error_code IS NOT NULL""")
def retryable_filter(spark, d):
    """Which refused entries may be sent again, with and without retrying throttled ones."""
    e = F.col("error_code")
    return fx.responses(spark, d).filter(e.isNotNull()).select(
        "request_id", "pos", "error_code", intake.can_retry(e, False).alias("retry"), intake.can_retry(e, True).alias("retry_strict"))


@query("shard_lookup", "SELECT source_id, hash_key, shard_no FROM routed")
def shard_lookup(spark, d):
    """Range join of hash keys and shards."""
    return fx.routed_records(spark, d).select("source_id", "hash_key", "shard_no")


@query("shard_lookup_by_stream", """
    SELECT source_id, k.stream_name, coalesce(o.shard_no, -1) AS shard_no
    FROM keyed k ASOF LEFT JOIN open_shards o ON o.stream_name = k.stream_name AND o.end_key >= k.hash_key""")
def shard_lookup_by_stream(spark, d):
    """The same lookup with a map per stream that grows with the number of keys."""
    m = shards.shard_ranges(scans.shard_pages_scan(fx.shard_pages(spark, d)), ["stream_name"])
    return shards.shard_lookup_index(fx.keyed(fx.user_records(spark, d)), shards.shard_index(m, ["stream_name"])).select("source_id", "stream_name", "shard_no")


@query("shard_lookup_down", """
    SELECT source_id, -1::BIGINT AS shard_no, true AS alone, 'no map' AS state FROM user_records
    UNION ALL SELECT source_id, -1, true, 'packing off' FROM user_records
    UNION ALL SELECT source_id, CASE WHEN hash_key <= '170141183460469231731687303715884105727' THEN shard_no ELSE -1 END,
                     hash_key > '170141183460469231731687303715884105727', 'partial map' FROM routed""")
def shard_lookup_down(spark, d):
    """No usable map, packing switched off, and a map that covers only half of the keys."""
    keyed = fx.keyed(fx.user_records(spark, d))
    ranges = shards.shard_ranges(fx.three_shards(spark).filter("shard_no <> 1"))
    cases = {
        "no map": shards.shard_lookup_or_alone(keyed, None),
        "packing off": shards.shard_lookup_or_alone(keyed, ranges, aggregation_enabled=False),
        "partial map": shards.shard_lookup_or_alone(keyed, ranges),
    }
    out = None
    for state, df in cases.items():
        part = df.select("source_id", "shard_no", "alone", F.lit(state).alias("state"))
        out = part if out is None else out.unionByName(part)
    return out


@query("shard_lookup_asof", """
    SELECT source_id, CASE WHEN arrival_ts < TIMESTAMP '2024-01-16' THEN shard_no
           ELSE CASE shard_no WHEN 2 THEN 5 WHEN 3 THEN 6 ELSE 7 END END::BIGINT AS shard_no FROM routed""")
def shard_lookup_asof(spark, d):
    """Lookup in the shard map version valid at arrival."""
    return shards.shard_lookup_asof(fx.keyed(fx.user_records(spark, d)), fx.shard_versions(spark)).select("source_id", "shard_no")

"""Queries over the streaming forms. Each runs the table as a stream and reads its sink back."""
from __future__ import annotations

from pyspark.sql import functions as F

from sparkpack.functions import metric_names as M
from sparkpack.operators import codec as C
from sparkpack.operators import intake, shards
from sparkpack.operators import metrics as MT
from sparkpack.operators.fold import BatchRule
from sparkpack.operators.stage import new_path
from sparkpack.plans import packing_queries as P
from sparkpack.plans.registry import query
from sparkpack.sources import fixtures as fx
from sparkpack.sources import scans
from sparkpack.streaming import outcomes, processors, statistics
from sparkpack.streaming.routing import MapInUse, route_with_feedback
from sparkpack.streaming.runner import run_and_close, run_each_batch, run_to_table, stream_session, table_stream

US = F.unix_micros
CFG = fx.SCALED


def event_stream(s, d):
    return table_stream(s, f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def record_stream(s, d):
    return fx.records_from_events(event_stream(s, d))


@query("stream_put_scan", """
    SELECT source_id, stream_name, partition_key, explicit_hash_key, hex(data) AS data_hex, epoch_us(arrival_ts) AS arrival_us FROM user_records""")
def stream_put_scan(spark, d):
    """Put records as a stream."""
    s = stream_session(spark)
    r = run_to_table(scans.put_records_scan(record_stream(s, d)).withWatermark("arrival_ts", "24 hours"))
    return r.select("source_id", "stream_name", "partition_key", "explicit_hash_key", F.hex("data").alias("data_hex"), US("arrival_ts").alias("arrival_us"))


@query("stream_pack", P.full_sql("false", """
    SELECT stream_name, shard_no, source_id AS id, batch_rn, pos, flush_us, reason, false AS late FROM fold"""))
def stream_pack(spark, d):
    """Packing with state per stream and shard; deadlines fire by the event clock, which the end of the stream moves past all."""
    s = stream_session(spark)
    return run_and_close(s, lambda ticks: processors.stream_pack(fx.routed(record_stream(s, d)), P.full_rule(CFG), ticks=ticks), CLOCK_END)


#: When the registered streams end: after every row of the tables.
CLOSE_AT = "2100-01-01 00:00:00"
CLOCK_END = "2100-01-02 00:00:00"
FLUSH_EVERY = 200


@query("stream_flush", f"""
    SELECT stream_name, shard_no, source_id, coalesce(at_us, epoch_us(TIMESTAMP '{CLOSE_AT}')) AS flush_us FROM (
      SELECT r.stream_name, r.shard_no, r.source_id,
             (SELECT epoch_us(min(e.ts)) FROM events e WHERE e.event_type = r.stream_name AND e.event_id % {FLUSH_EVERY} = {FLUSH_EVERY - 1} AND e.ts >= r.arrival_ts) AS at_us
      FROM routed r)""")
def stream_flush(spark, d):
    """Flush commands inside the stream empty the state of every shard of their stream; the end flushes the rest."""
    s = stream_session(spark)
    every = F.array(*[F.lit(n).cast("bigint") for n, _ in fx.THREE_SHARDS])
    commands = event_stream(s, d).filter(F.col("event_id") % FLUSH_EVERY == FLUSH_EVERY - 1).select(
        F.col("event_type").alias("stream_name"), F.explode(every).alias("shard_no"), F.col("ts").alias("flush_ts"))
    rule = BatchRule(use_deadline=False)
    out = run_and_close(s, lambda ticks: processors.stream_pack(fx.routed(record_stream(s, d)), rule, commands, ticks), CLOCK_END)
    return out.select("stream_name", "shard_no", F.col("id").alias("source_id"), "flush_us")


@query("stream_rate_limit", P._shape_sql(1 / P.RECORDS.rate, P.RECORDS.depth, True, True, """
    SELECT stream_name, shard_no, source_id, CASE WHEN NOT late THEN round(send, 3) END AS send_s, late AS expired FROM r"""))
def stream_rate_limit(spark, d):
    """Token buckets as state per shard."""
    s = stream_session(spark)
    out = run_to_table(processors.stream_rate_limit(fx.routed(record_stream(s, d)), P.RECORDS, P.BYTES))
    return out.withColumn("send_s", F.round("send_s", 3))


def bucket_partials(spark, d, width_s):
    """Partials of all samples by buckets of width_s seconds; several partials of one bucket merge."""
    s = stream_session(spark)
    return run_and_close(s, lambda ticks: statistics.stream_buckets(
        fx.samples_from_events(event_stream(s, d)), M.dims_text(F.col("dims")), width_s, ticks=ticks), CLOCK_END)


WINDOW_STATS = "count(value) AS count, round(sum(value), 2) AS sum, min(value) AS min, max(value) AS max"


@query("stream_metrics_second", f"SELECT dims, epoch_us(ts) // 1000000 AS second, {WINDOW_STATS} FROM samples_dims GROUP BY 1, 2")
def stream_metrics_second(spark, d):
    """One-second statistics; late samples arrive as corrections of their second."""
    out = bucket_partials(spark, d, 1).groupBy("dims", F.col("bucket").alias("second")).agg(*MT.merge_stats())
    return out.withColumn("sum", F.round("sum", 2))


@query("stream_metrics_minute", f"""
    SELECT dims, start_s, {WINDOW_STATS} FROM (
      SELECT *, unnest([epoch_us(ts) // 30000000 * 30 - 30, epoch_us(ts) // 30000000 * 30]) AS start_s FROM samples_dims) GROUP BY 1, 2""")
def stream_metrics_minute(spark, d):
    """Sixty-second statistics every thirty seconds, each from two half-minute buckets."""
    halves = bucket_partials(spark, d, 30)
    starts = F.explode(F.array((F.col("bucket") - 1) * 30, F.col("bucket") * 30))
    out = halves.withColumn("start_s", starts).groupBy("dims", "start_s").agg(*MT.merge_stats())
    return out.withColumn("sum", F.round("sum", 2))


RESULT_TTL_MS = 500


@query("stream_results_join", f"""
    SELECT u.source_id, CASE WHEN r.source_id IS NULL THEN 'Expired' WHEN r.success THEN 'delivered' ELSE 'failed' END AS outcome
    FROM user_records u LEFT JOIN results r ON r.source_id = u.source_id AND r.finished_ts BETWEEN u.arrival_ts AND u.arrival_ts + INTERVAL {RESULT_TTL_MS} MILLISECOND
    UNION ALL SELECT source_id, 'orphan' FROM results r WHERE NOT EXISTS (SELECT 1 FROM user_records u WHERE u.source_id = r.source_id)""")
def stream_results_join(spark, d):
    """Records and their results as both arrive; no result within the time limit means expired."""
    s = stream_session(spark)
    out = run_and_close(s, lambda ticks: outcomes.stream_outcomes(
        record_stream(s, d), fx.results_from_events(event_stream(s, d)), RESULT_TTL_MS, ticks=ticks), CLOCK_END)
    return out.select("source_id", "outcome")


@query("stream_finish_once", "SELECT DISTINCT source_id FROM results")
def stream_finish_once(spark, d):
    """Only the first terminal result of a record counts."""
    s = stream_session(spark)
    return run_to_table(outcomes.finish_once(fx.results_from_events(event_stream(s, d)), CFG.record_ttl_ms), idle=False).select("source_id")


@query("stream_shard_refresh", """
    SELECT source_id, k.stream_name, coalesce(o.shard_no, -1) AS shard_no
    FROM keyed k ASOF LEFT JOIN open_shards o ON o.stream_name = k.stream_name AND o.end_key >= k.hash_key""")
def stream_shard_refresh(spark, d):
    """Micro-batches are routed by one shard map until a result shows a record in another shard; then it is read again."""
    s = stream_session(spark)
    maps = MapInUse(lambda session: scans.shard_pages_scan(fx.shard_pages(session, d)))

    def stored(batch):
        """The service keeps to the map of the tables, so what it stores where is a lookup of its own."""
        now = shards.shard_lookup(batch.drop("shard_no"), shards.shard_ranges(scans.shard_pages_scan(fx.shard_pages(batch.sparkSession, d)), ["stream_name"]), on=["stream_name"])
        there = now.select("source_id", F.col("shard_no").alias("stored_shard"))
        return batch.select("source_id", "stream_name", F.col("shard_no").alias("predicted_shard")).join(there, "source_id")

    step = route_with_feedback(maps, stored)
    return run_each_batch(record_stream(s, d), lambda batch: step(fx.keyed(batch)).select("source_id", "stream_name", "shard_no"),
                          "source_id long, stream_name string, shard_no long")


@query("stream_deaggregate", """
    SELECT stream_name, shard_no, batch_no, pos AS sub_sequence, partition_key,
           CASE WHEN n > 1 THEN explicit_hash_key END AS explicit_hash_key, hex(data) AS data_hex, n > 1 AS aggregated
    FROM count_batches JOIN (SELECT stream_name, shard_no, batch_no, n FROM packed) USING (stream_name, shard_no, batch_no)""")
def stream_deaggregate(spark, d):
    """A stream of packed records unpacked."""
    path = new_path(spark, "packed")
    P.packed(spark, d).select(*P.CONSUMER).write.parquet(path)
    s = stream_session(spark)
    out = run_to_table(C.deaggregate_records(table_stream(s, path)))
    return out.select(*P.BATCH, "sub_sequence", "partition_key", "explicit_hash_key", F.hex("data").alias("data_hex"), "aggregated")


@query("stream_late_expired", """
    SELECT stream_name, expiration < (SELECT max(arrival_ts) FROM user_records) AS expired, count(*) AS n
    FROM (SELECT *, arrival_ts + INTERVAL 24 HOUR AS expiration FROM user_records) GROUP BY 1, 2""")
def stream_late_expired(spark, d):
    """Rows beyond their time to live are counted before any stateful step."""
    s = stream_session(spark)
    # "now" comes from outside the stream, so counts don't depend on how it is cut into micro-batches
    newest = fx.user_records(spark, d).agg(F.max("arrival_ts").alias("t")).first()["t"]

    def split(batch):
        timed = intake.assign_times(batch, CFG)
        return intake.mark_expired(timed, F.lit(newest)).groupBy("stream_name", "expired").agg(F.count(F.lit(1)).alias("n"))

    out = run_each_batch(record_stream(s, d), split, "stream_name string, expired boolean, n long")
    return out.groupBy("stream_name", "expired").agg(F.sum("n").alias("n"))

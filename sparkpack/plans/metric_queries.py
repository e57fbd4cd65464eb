"""Queries over delivery metrics and framed logs."""
from __future__ import annotations

from pyspark.sql import functions as F

from sparkpack.functions import metric_names as M
from sparkpack.operators import logs as L
from sparkpack.operators import metrics as MT
from sparkpack.operators import outcomes as O
from sparkpack.plans.outcome_queries import matched
from sparkpack.plans.registry import query
from sparkpack.sources import fixtures as fx

US = F.unix_micros
STATS_SQL = "count(value) AS count, round(sum(value), 2) AS sum, min(value) AS min, max(value) AS max, round(sum(value), 2) / count(value) AS mean"
AS_OF = "2024-01-16 00:01:30"
AS_OF_S = 1_705_363_290


def stats(df, *columns):
    """Statistics as report columns; sums are rounded to the two decimals the samples have."""
    total = F.round("sum", 2)
    return df.select(*columns, "count", total.alias("sum"), "min", "max", (total / F.col("count")).alias("mean"))


def dims_text():
    return M.dims_text(F.col("dims")).alias("dims")


@query("metric_totals", f"SELECT dims, {STATS_SQL} FROM samples_dims GROUP BY 1")
def metric_totals(spark, d):
    """Statistics per full dimension set."""
    return stats(MT.metric_totals(fx.metric_samples(spark, d)), dims_text())


@query("metric_per_second", f"SELECT dims, epoch_us(ts) // 1000000 AS second, {STATS_SQL} FROM samples_dims GROUP BY 1, 2")
def metric_per_second(spark, d):
    """Statistics per one-second bucket."""
    return stats(MT.metric_per_second(fx.metric_samples(spark, d)), dims_text(), "second")


@query("metric_trailing", f"""
    SELECT dims, {STATS_SQL} FROM samples_dims
    WHERE epoch_us(ts) // 1000000 > {AS_OF_S} - 60 AND epoch_us(ts) // 1000000 <= {AS_OF_S} GROUP BY 1""")
def metric_trailing(spark, d):
    """Last sixty seconds before one moment, merged from one-second partials."""
    return stats(MT.metric_trailing(MT.metric_per_second(fx.metric_samples(spark, d)), AS_OF_S), dims_text())


@query("metric_trailing_each", """
    SELECT dims, second, sum(n) OVER w::BIGINT AS count, round(sum(s) OVER w, 2) AS sum, min(lo) OVER w AS min, max(hi) OVER w AS max,
           round(sum(s) OVER w, 2) / sum(n) OVER w::BIGINT AS mean
    FROM (SELECT dims, epoch_us(ts) // 1000000 AS second, count(*) AS n, sum(value) AS s, min(value) AS lo, max(value) AS hi
          FROM samples_dims GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY dims ORDER BY second RANGE BETWEEN 59 PRECEDING AND CURRENT ROW)""")
def metric_trailing_each(spark, d):
    """Last sixty seconds at every second that has samples."""
    return stats(MT.metric_trailing_each(MT.metric_per_second(fx.metric_samples(spark, d))), dims_text(), "second")


def rolled_up(spark, d):
    return MT.metric_rollup(MT.metric_totals(fx.metric_samples(spark, d)))


@query("metric_rollup", f"SELECT dims, n_dims::BIGINT AS n_dims, {STATS_SQL} FROM metric_prefixes GROUP BY 1, 2")
def metric_rollup(spark, d):
    """Statistics at every dimension prefix."""
    return stats(rolled_up(spark, d), dims_text(), F.size("dims").cast("bigint").alias("n_dims"))


@query("metric_filter", f"""
    SELECT dims, {STATS_SQL} FROM metric_prefixes
    WHERE regexp_extract(dims, 'MetricName=([A-Za-z]+)', 1) IN ('UserRecordsPut', 'ErrorsByCode', 'BufferingTime') AND NOT contains(dims, 'ShardId')
    GROUP BY 1""")
def metric_filter(spark, d):
    """Summary metrics down to stream granularity."""
    return stats(MT.metric_filter(rolled_up(spark, d), "summary", "stream"), dims_text())


@query("metric_by_name", f"SELECT dims, {STATS_SQL} FROM metric_prefixes WHERE dims = 'MetricName=ErrorsByCode' OR dims LIKE 'MetricName=ErrorsByCode,%' GROUP BY 1")
def metric_by_name(spark, d):
    """All statistics of one metric."""
    return stats(MT.metric_by_name(rolled_up(spark, d), "ErrorsByCode"), dims_text())


@query("extra_dimensions", f"""
    SELECT 'MetricName=' || name || coalesce(',ErrorCode=' || error_code, '') || ',Region=north,StreamName=' || stream_name || ',Tier=hot'
           || coalesce(',ShardId=' || shard_id || ',Rack=7', '') AS dims, {STATS_SQL} FROM metric_samples GROUP BY 1""")
def extra_dimensions(spark, d):
    """Configured dimensions added at their level."""
    extras = [("Region", "north", "global"), ("Tier", "hot", "stream"), ("Rack", "7", "shard")]
    return stats(MT.metric_totals(MT.extra_dimensions(fx.metric_samples(spark, d), extras)), dims_text())


@query("metric_elapsed", """
    SELECT dims, (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(min(ts))) / 1000000.0::DOUBLE AS elapsed_s FROM samples_dims GROUP BY 1""")
def metric_elapsed(spark, d):
    """Seconds covered by each statistic."""
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return MT.metric_elapsed(fx.metric_samples(spark, d), as_of).select(dims_text(), "elapsed_s")


@query("metrics_response", f"""
    SELECT 'BufferingTime' AS name, substr(replace(dims, 'MetricName=BufferingTime', ''), 2) AS dims, {STATS_SQL}, 60::BIGINT AS seconds
    FROM metric_prefixes WHERE (dims = 'MetricName=BufferingTime' OR dims LIKE 'MetricName=BufferingTime,%')
      AND epoch_us(ts) // 1000000 > {AS_OF_S} - 60 AND epoch_us(ts) // 1000000 <= {AS_OF_S} GROUP BY dims""")
def metrics_response(spark, d):
    """Answer to a request for one metric over the trailing window."""
    window = MT.metric_trailing(MT.metric_per_second(MT.metric_by_name(fx.metric_samples(spark, d), "BufferingTime")), AS_OF_S)
    answer = MT.metrics_response(MT.metric_rollup(window), F.lit(60).cast("bigint"))
    return stats(answer, "name", dims_text(), "seconds")


@query("metric_datums", f"""
    SELECT regexp_extract(dims, 'MetricName=([A-Za-z]+)', 1) AS name, regexp_replace(dims, '^MetricName=[A-Za-z]+,?', '') AS dims,
           CASE regexp_extract(dims, 'MetricName=([A-Za-z]+)', 1) WHEN 'BufferingTime' THEN 'Milliseconds' WHEN 'UserRecordsDataPut' THEN 'Bytes' ELSE 'Count' END AS unit,
           {STATS_SQL} FROM metric_prefixes GROUP BY metric_prefixes.dims""")
def metric_datums(spark, d):
    """Statistics as upload rows."""
    return stats(MT.metric_datums(rolled_up(spark, d)), "name", dims_text(), "unit")


#: A bound that some batches of the test tables meet before they hold twenty metrics.
SMALL_UPLOAD = 9_000


@query("metric_batches", f"""
    WITH RECURSIVE o AS (
      SELECT dims, strlen(dims) + {MT.DIMENSION_BYTES} * n_dims + {MT.DATUM_BYTES} AS size, row_number() OVER (ORDER BY n_dims, dims) AS rn
      FROM (SELECT DISTINCT dims, n_dims FROM metric_prefixes)),
    r AS (
      SELECT dims, rn, size, 0::BIGINT AS batch_no, 0::BIGINT AS pos FROM o WHERE rn = 1
      UNION ALL
      SELECT o.dims, o.rn, CASE WHEN new THEN o.size ELSE r.size + o.size END, CASE WHEN new THEN r.batch_no + 1 ELSE r.batch_no END, CASE WHEN new THEN 0 ELSE r.pos + 1 END
      FROM r JOIN o ON o.rn = r.rn + 1, LATERAL (SELECT r.pos = 19 OR r.size + o.size > {SMALL_UPLOAD} AS new))
    SELECT dims, batch_no, pos FROM r""")
def metric_batches(spark, d):
    """Upload batches of at most twenty metrics and a bound of bytes."""
    return MT.metric_batches(rolled_up(spark, d), batch_bytes=SMALL_UPLOAD).select(F.col("dims_text").alias("dims"), "batch_no", "pos")


@query("error_counts", f"""
    SELECT stream_name, shard_no, name, error_code, count(*) AS count, sum(value) AS sum FROM (
      SELECT stream_name, shard_no, 'AllErrors' AS name, NULL AS error_code, CASE WHEN success THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS value FROM attempts
      UNION ALL SELECT stream_name, shard_no, 'ErrorsByCode', error_code, 1.0 FROM attempts WHERE NOT success) GROUP BY 1, 2, 3, 4""")
def error_counts(spark, d):
    """Errors per stream and shard, in total and by code."""
    return MT.error_counts(fx.attempts(spark, d)).select("stream_name", "shard_no", "name", "error_code", "count", "sum")


@query("delivery_metrics", f"""
    SELECT stream_name, shard_no, name, {STATS_SQL} FROM (
      SELECT stream_name, shard_no, 'UserRecordsPut' AS name, CASE WHEN success THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM last_attempts
      UNION ALL SELECT stream_name, shard_no, 'UserRecordsDataPut', data_bytes FROM last_attempts WHERE success
      UNION ALL SELECT stream_name, shard_no, 'UserRecordExpired', 1.0 FROM last_attempts WHERE error_code = 'Expired'
      UNION ALL SELECT stream_name, shard_no, 'RetriesPerRecord', attempt_no - 1 FROM last_attempts) GROUP BY 1, 2, 3""")
def delivery_metrics(spark, d):
    """Samples of finished records."""
    samples = MT.delivery_samples(O.final_attempt(fx.attempts(spark, d)))
    return stats(MT.metric_totals(samples, ["stream_name", "shard_no", "name"]), "stream_name", "shard_no", "name")


@query("buffering_time", f"""
    SELECT stream_name, {STATS_SQL} FROM (
      SELECT stream_name, (epoch_us(start_ts) - epoch_us(coalesce(lag(end_ts) OVER (PARTITION BY source_id ORDER BY attempt_no), arrival_ts))) / 1000 AS value
      FROM attempts) GROUP BY 1""")
def buffering_time(spark, d):
    """Time records waited before each attempt."""
    return stats(MT.metric_totals(MT.buffering_time(fx.attempts(spark, d)), ["stream_name"]), "stream_name")


@query("packing_metrics", f"""
    SELECT name, {STATS_SQL} FROM (
      SELECT 'UserRecordsPerKinesisRecord' AS name, n_members::DOUBLE AS value FROM request_entries
      UNION ALL SELECT 'KinesisRecordsPerPutRecordsRequest', count(*) FROM request_entries GROUP BY request_id
      UNION ALL SELECT 'UserRecordsPerPutRecordsRequest', sum(n_members) FROM request_entries GROUP BY request_id
      UNION ALL SELECT 'RequestTime', (epoch_us(end_ts) - epoch_us(start_ts)) / 1000 FROM requests) GROUP BY 1""")
def packing_metrics(spark, d):
    """How full entries and requests were and how long requests took."""
    return stats(MT.packing_metrics(fx.request_entries(spark, d), fx.requests(spark, d)), "name")


@query("shard_put_metrics", """
    SELECT predicted_shard, count(*) AS entries, count(sequence_number) AS stored,
           coalesce(sum(data_bytes) FILTER (sequence_number IS NOT NULL), 0)::BIGINT AS stored_bytes
    FROM matched WHERE action = 'per_record' AND NOT mismatch GROUP BY 1""")
def shard_put_metrics(spark, d):
    """Stored entries and bytes per shard."""
    return MT.shard_put_metrics(matched(spark, d))


@query("pending_gauge", """
    SELECT stream_name, tick, sum(step) OVER (PARTITION BY stream_name ORDER BY tick)::BIGINT AS pending FROM (
      SELECT stream_name, tick, sum(step) AS step FROM (
        SELECT stream_name, epoch_us(arrival_ts) // 200000 AS tick, 1 AS step FROM user_records
        UNION ALL
        SELECT stream_name, epoch_us(min(finished_ts)) // 200000, -1 FROM results JOIN user_records USING (source_id) GROUP BY source_id, stream_name)
      GROUP BY 1, 2)""")
def pending_gauge(spark, d):
    """Records in flight per stream at each 200 ms tick."""
    records = fx.user_records(spark, d).select("source_id", "stream_name", "arrival_ts")
    done = fx.results(spark, d).groupBy("source_id").agg(F.min("finished_ts").alias("finished_ts")).join(
        records.select("source_id", "stream_name"), "source_id")
    return MT.pending_gauge(records, done)


@query("progress_counts", """
    SELECT count(*) FILTER (success) AS n_success, count(*) FILTER (NOT success) AS n_error,
           arg_min(sequence_number, (finished_ts, source_id)) FILTER (success) AS first_sequence_number FROM results""")
def progress_counts(spark, d):
    """Delivered and failed results and the first sequence number."""
    return MT.progress_counts(fx.results(spark, d))


# -- framed logs ---------------------------------------------------------------------------------------------

FRAMES_SQL = """
    WITH marked AS (
      SELECT source, line_no, line, CASE WHEN line LIKE '++++%' THEN 'S' WHEN line LIKE '----%' THEN 'E' END AS marker FROM log_lines),
    seg AS (
      SELECT *, count(marker) OVER (PARTITION BY source ORDER BY line_no) AS seg,
             last_value(marker IGNORE NULLS) OVER (PARTITION BY source ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS state FROM marked),
    closers AS (SELECT source, seg - 1 AS seg, marker AS closer, line_no AS close_line FROM seg WHERE marker IS NOT NULL),
    openers AS (SELECT source, seg, marker AS opener FROM seg WHERE marker IS NOT NULL),
    inner_lines AS (SELECT source, seg, count(*) AS n_lines, min(line_no) AS first_line, string_agg(line, chr(10) ORDER BY line_no) AS text
                    FROM seg WHERE marker IS NULL AND state = 'S' GROUP BY 1, 2),
    records AS (
      SELECT i.source, first_line, CASE WHEN closer IS NULL THEN 'open' ELSE 'frame' END AS kind, text
      FROM inner_lines i LEFT JOIN closers c USING (source, seg) WHERE closer IS NULL OR closer = 'E'
      UNION ALL SELECT source, line_no, 'loose', line FROM seg WHERE marker IS NULL AND coalesce(state, 'E') = 'E')
"""


@query("log_frames", FRAMES_SQL + "SELECT source, first_line, kind, text FROM records")
def log_frames(spark, d):
    """Framed log lines as records."""
    return L.log_frames(fx.log_lines(spark, d))


@query("log_levels", FRAMES_SQL + """
    SELECT source, level, count(*) AS n, sum(length(text))::BIGINT AS chars FROM (
      SELECT source, CASE WHEN kind <> 'frame' THEN CASE source WHEN 'StdOut' THEN 'info' ELSE 'warn' END
                          WHEN word = 'warning' OR word = '' THEN 'warn' WHEN word = 'fatal' THEN 'error' ELSE word END AS level,
             CASE WHEN kind <> 'frame' THEN text WHEN word = '' THEN '!!Failed to extract level!! - ' || text ELSE replace(text, word || ':', '') END AS text
      FROM (SELECT *, regexp_extract(text, '(trace|debug|info|warn(?:ing)?|error|fatal)', 1) AS word FROM records)) GROUP BY 1, 2""")
def log_levels(spark, d):
    """Records and characters per source and level."""
    return L.log_levels(L.log_frames(fx.log_lines(spark, d))).groupBy("source", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("log_anomalies", FRAMES_SQL + """
    , gaps AS (SELECT c.source, c.closer, c.close_line, o.opener, coalesce(i.n_lines, 0) AS n_lines FROM closers c
               LEFT JOIN openers o USING (source, seg) LEFT JOIN inner_lines i USING (source, seg))
    SELECT source, close_line AS line_no, 'data dropped' AS kind FROM gaps WHERE closer = 'S' AND opener = 'S' AND n_lines > 0
    UNION ALL SELECT source, close_line, 'no start' FROM gaps WHERE closer = 'E' AND coalesce(opener, 'E') = 'E'
    UNION ALL SELECT source, close_line, 'no data' FROM gaps WHERE closer = 'E' AND (coalesce(opener, 'E') = 'E' OR n_lines = 0)""")
def log_anomalies(spark, d):
    """Dropped data, terminators without a start, and terminators without data."""
    return L.log_anomalies(fx.log_lines(spark, d))

"""End-to-end queries: the put path, the round trip, and the delivery report."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpack.config import PackConfig
from sparkpack.operators import codec as C
from sparkpack.operators import intake
from sparkpack.operators import metrics as MT
from sparkpack.operators import outcomes as O
from sparkpack.operators import rounds as R
from sparkpack.operators import shaping as S
from sparkpack.operators.fold import BatchRule
from sparkpack.operators.stage import materialize
from sparkpack.plans import packing_queries as P
from sparkpack.plans.registry import query
from sparkpack.sources import fixtures as fx

US = F.unix_micros
PACK = ["stream_name", "shard_no", "batch_rn"]


def pack(records: DataFrame, cfg: PackConfig) -> DataFrame:
    """Valid, routed records to packed rows. Payloads meet their batch by record id, once.

    Records without a shard, or all if packing is off, flush at once and travel alone.
    """
    alone = (F.col("shard_no") == -1) | F.lit(not cfg.aggregation_enabled)
    batches = P.full_batches(records, cfg, flag=alone).select(F.col("id").alias("source_id"), "batch_rn", "pos", "flush_us")
    joined = records.join(batches, "source_id")
    rows = C.aggregate_records(joined, PACK)
    flushed = batches_flush_time(joined)
    return rows.join(flushed, PACK).withColumn("arrival_ts", F.timestamp_micros("flush_us")).drop("flush_us")


def batches_flush_time(joined: DataFrame) -> DataFrame:
    return joined.groupBy(*PACK).agg(F.max("flush_us").alias("flush_us"))


#: What a shard takes, seconds for a record and for a byte: chosen so that at sf0.01 some batches wait and a few expire.
RECORD_S, BYTE_S = 34_000, 110
SHARD_RECORDS, SHARD_BYTES = S.Bucket(5.0, 1 / RECORD_S), S.Bucket(2_000.0, 1 / BYTE_S)


def as_items(packed: DataFrame) -> DataFrame:
    """Packed rows as what travels: named by their first record, with the size the service counts."""
    return packed.withColumns({
        "item_id": F.element_at("source_ids", 1),
        "item_size": (F.octet_length("partition_key") + F.col("exact_size")).cast("bigint")}).drop("data", "source_ids")


def shape(items: DataFrame, cfg: PackConfig, per_record: S.Bucket | None = None, per_byte: S.Bucket | None = None) -> DataFrame:
    """Items with `expired`, and for the others their send time as arrival_ts, under the shard's record and byte limits; what
    still waits when it expires leaves the queue then. Items without a shard are not held."""
    per_record = per_record or S.Bucket(cfg.shard_records_per_sec, cfg.record_rate)
    per_byte = per_byte or S.Bucket(cfg.shard_bytes_per_sec, cfg.byte_rate)
    held = items.filter("shard_no <> -1").withColumnRenamed("item_id", "source_id")
    limited = S.rate_limit_expired(held, per_record, per_byte, F.col("exact_size"), cfg.slice_ms)
    sent = held.join(limited, "source_id").withColumnRenamed("source_id", "item_id")
    sent = sent.withColumn("arrival_ts", F.when(~F.col("expired"), F.timestamp_micros(F.round((F.col("send_s") + S.EPOCH_S) * 1_000_000).cast("bigint"))))
    free = items.filter("shard_no = -1").withColumn("expired", F.col("expiration_ts") < F.col("arrival_ts"))
    free = free.withColumn("arrival_ts", F.when(~F.col("expired"), F.col("arrival_ts")))
    return sent.drop("send_s").unionByName(free)


PUT_CONFIG = fx.SCALED.with_(
    record_max_buffered_ms=96 * fx.HOUR, record_ttl_ms=120 * fx.HOUR, aggregation_max_count=10, shard_burst_size=2_500)


@query("put_pipeline", P.full_sql("false", """,
    packed_batches AS (
      SELECT f.stream_name, f.shard_no, f.batch_rn, any_value(f.flush_us) AS arr, min(r.due) AS due, min(r.expire) AS expire, count(*) AS n,
             arg_min(f.source_id, f.pos) AS id, arg_min(strlen(r.partition_key), f.pos) AS first_key
      FROM fold f JOIN put_times r ON r.source_id = f.source_id GROUP BY 1, 2, 3),
    travelling AS (
      SELECT b.*, s.exact::BIGINT AS exact, (s.exact + CASE WHEN b.n = 1 THEN first_key ELSE 1 END)::BIGINT AS size,
             (b.arr - {EPOCH}000000) / 1000000.0::DOUBLE AS at_s, (b.expire - {EPOCH}000000) / 1000000.0::DOUBLE AS expire_s,
             row_number() OVER (PARTITION BY b.stream_name, b.shard_no ORDER BY b.due, b.arr, b.id) AS q
      FROM packed_batches b JOIN spans s ON s.stream_name = b.stream_name AND s.shard_no = b.shard_no AND s.s = b.batch_rn AND s.t = b.batch_rn + b.n - 1),
    queue AS (
      SELECT stream_name, shard_no, 0::BIGINT AS q, 0::BIGINT AS id, 0::DOUBLE AS send, false AS late, -1e18::DOUBLE AS hold, -1e18::DOUBLE AS t1, -1e18::DOUBLE AS t2
      FROM travelling WHERE q = 1
      UNION ALL
      SELECT stream_name, shard_no, q, id, moment, gone, CASE WHEN gone THEN greatest(hold, expire_s) ELSE hold END,
             CASE WHEN gone THEN t1 ELSE greatest(t1, moment) + {RECORD_S} END, CASE WHEN gone THEN t2 ELSE greatest(t2, moment) + exact * {BYTE_S} END
      FROM (SELECT *, moment > expire_s OR exact > 2000 AS gone
            FROM (SELECT i.*, w.hold, w.t1, w.t2, greatest(i.at_s, w.hold, w.t1 + {RECORD_S} - 5 * {RECORD_S}, w.t2 + i.exact * {BYTE_S} - 2000 * {BYTE_S}) AS moment
                  FROM queue w JOIN travelling i ON i.stream_name = w.stream_name AND i.shard_no = w.shard_no AND i.q = w.q + 1))),
    sent AS (
      SELECT i.stream_name, i.shard_no, i.id, i.n, i.size, round((w.send + {EPOCH}) * 1000000)::BIGINT AS arr, i.due, i.shard_no AS burst, i.exact AS burst_size, w.late
      FROM travelling i JOIN queue w ON w.stream_name = i.stream_name AND w.shard_no = i.shard_no AND w.q = i.q),
    on_time AS (SELECT * EXCLUDE (late) FROM sent WHERE NOT late),""".replace(
        "{EPOCH}", str(S.EPOCH_S)).replace("{RECORD_S}", str(RECORD_S)).replace("{BYTE_S}", str(BYTE_S)) + P.arrivals_sql("on_time", "stream_name", P.burst_rule(PUT_CONFIG)) + """
    SELECT f.stream_name, f.batch_id AS request_id, any_value(f.reason) AS outcome, count(*) AS entries, sum(s.n)::BIGINT AS records, sum(s.size)::BIGINT AS bytes,
           min(s.arr) AS first_send_us, max(s.arr) AS last_send_us, any_value(f.flush_us) AS flush_us
    FROM (SELECT stream_name, batch_id, flush_us, reason, unnest(gone).id AS id FROM flushes) f JOIN sent s ON s.id = f.id GROUP BY 1, 2
    UNION ALL SELECT stream_name, id, 'Expired', 1, n::BIGINT, size, NULL, NULL, NULL FROM sent WHERE late""", PUT_CONFIG, "put_records"))
def put_pipeline(spark, d):
    """Validate, key, route, pack, shape and collect: one row per put request, and one per packed record that expired in the queue."""
    cfg = PUT_CONFIG
    records = materialize(fx.routed(intake.valid_records(fx.dirty_records(spark, d)), cfg))
    items = materialize(as_items(pack(records, cfg)))
    shaped = materialize(shape(items, cfg, SHARD_RECORDS, SHARD_BYTES))
    requests = P.collect_arriving(shaped.filter("NOT expired"), cfg).groupBy("stream_name", "request_id").agg(
        F.first("reason").alias("outcome"), F.count(F.lit(1)).alias("entries"), F.sum("n_records").alias("records"), F.sum("item_size").alias("bytes"),
        US(F.min("arrival_ts")).alias("first_send_us"), US(F.max("arrival_ts")).alias("last_send_us"), F.first("flush_us").alias("flush_us"))
    never = F.lit(None).cast("bigint")
    lost = shaped.filter("expired").select(
        "stream_name", F.col("item_id").alias("request_id"), F.lit(O.EXPIRED[0]).alias("outcome"), F.lit(1).cast("bigint").alias("entries"),
        F.col("n_records").alias("records"), F.col("item_size").alias("bytes"), never.alias("first_send_us"), never.alias("last_send_us"), never.alias("flush_us"))
    return requests.unionByName(lost)


@query("round_trip", """
    SELECT stream_name, count(*) AS n_in, count(*) AS n_out, 0::BIGINT AS missing, 0::BIGINT AS unexpected FROM routed GROUP BY 1""")
def round_trip(spark, d):
    """Pack and unpack; records that did not survive, per stream."""
    records = fx.routed_table(spark, d)
    packed = materialize(pack(records, fx.SCALED))
    back = C.deaggregate_records(packed.select("stream_name", "source_ids", "partition_key", "explicit_hash_key", "data"))
    fields = ["stream_name", "source_id", "partition_key", "data"]
    # a batch of one travels unpacked: its explicit key is the hash key outside the data
    out = back.withColumn("source_id", F.get("source_ids", F.col("sub_sequence").cast("int"))).select(
        *fields, F.when(F.col("aggregated"), F.coalesce("explicit_hash_key", F.lit(""))).alias("ehk"))
    src = records.select(*fields, F.coalesce("explicit_hash_key", F.lit("")).alias("ehk_in"))
    both = src.withColumn("_in", F.lit(1)).join(
        out.withColumn("_out", F.lit(1)), fields, "full").filter("ehk IS NULL OR ehk_in IS NULL OR ehk = ehk_in")
    return both.groupBy("stream_name").agg(
        F.count("_in").alias("n_in"), F.count("_out").alias("n_out"),
        F.count_if(F.col("_out").isNull()).alias("missing"), F.count_if(F.col("_in").isNull()).alias("unexpected"))


ROUND_CONFIG = fx.SCALED.with_(record_ttl_ms=12 * fx.HOUR)
ROUND_RULE = BatchRule(size_limit=200, count_limit=12)
#: Rounds the SQL spells out; no record of the tables is still pending after them.
SQL_ROUNDS = 14


def scripted(batches: DataFrame, number: int) -> DataFrame:
    """A service that answers by batch and round: of eight batches two meet an error that passes, one goes to the wrong shard, one
    meets an error that stays."""
    k = (F.col("batch_id") + 7 * number) % 8
    code = F.when(k == 0, fx.THROTTLED).when(k == 1, "InternalFailure").when(k == 3, "xx")
    return R.answer_by_code(batches, code, F.concat(F.lit("batch "), F.col("batch_id").cast("string")), k == 2, F.lit(10) + F.col("batch_id") % 90, ROUND_CONFIG)


def _rounds_sql() -> str:
    h = 3_600_000_000
    parts = [f"""
    WITH pending_1 AS (
      SELECT stream_name, shard_no, source_id AS id, strlen(data)::BIGINT AS size, epoch_us(arrival_ts) AS arr, epoch_us(arrival_ts) + {6 * h} AS due,
             epoch_us(arrival_ts) + {12 * h} AS expire, 0::BIGINT AS tries, -1 AS burst, 0::BIGINT AS burst_size FROM routed)"""]
    for r in range(1, SQL_ROUNDS + 1):
        parts.append(f""",
    tried_{r} AS MATERIALIZED (
      SELECT p.*, f.flush_us AS start_us, f.flush_us + (10 + f.batch_id % 90) * 1000 AS end_us, (f.batch_id + {7 * r}) % 8 AS k
      FROM (WITH RECURSIVE {P.arrivals_sql(f'pending_{r}', 'stream_name, shard_no', ROUND_RULE)}
            SELECT batch_id, flush_us, unnest(gone).id AS id FROM flushes) f JOIN pending_{r} p ON p.id = f.id),
    pending_{r + 1} AS (
      SELECT stream_name, shard_no, id, size, end_us AS arr, least(end_us + {3 * h}, expire) AS due, expire, tries + 1 AS tries, burst, burst_size
      FROM tried_{r} WHERE k < 3 AND expire >= end_us)""")
    every = " UNION ALL ".join(f"SELECT {r}::BIGINT AS round, * FROM tried_{r}" for r in range(1, SQL_ROUNDS + 1))
    return "".join(parts) + f""",
    tried AS ({every}),
    tries_of AS (
      SELECT id, round, 2 * tries AS no, end_us, CASE k WHEN 0 THEN '{fx.THROTTLED}' WHEN 1 THEN 'InternalFailure' WHEN 2 THEN '{O.WRONG_SHARD[0]}' WHEN 3 THEN 'xx' ELSE 'ok' END AS code FROM tried
      UNION ALL SELECT id, round, 2 * tries + 1, end_us, '{O.EXPIRED[0]}' FROM tried WHERE k < 3 AND expire < end_us)
    SELECT id AS source_id, string_agg(code, '|' ORDER BY no) AS history, count(*) AS n_attempts, max(round) AS rounds, max(end_us) AS end_us,
           CASE arg_max(code, no) WHEN 'ok' THEN 'delivered' WHEN '{O.EXPIRED[0]}' THEN 'expired' ELSE 'failed' END AS state
    FROM tries_of GROUP BY 1"""


@query("delivery_rounds", _rounds_sql())
def delivery_rounds(spark, d):
    """Pack, send, and pack again what came back, until every record is delivered, failed or expired; one row per record."""
    attempts, _ = R.deliver(fx.routed(fx.user_records(spark, d), ROUND_CONFIG), scripted, ROUND_CONFIG, ROUND_RULE)
    out, last = R.final_states(attempts), F.element_at("attempts", -1)
    return out.select(
        "source_id", F.array_join(F.transform("attempts", lambda a: F.when(a["success"], "ok").otherwise(a["error_code"])), "|").alias("history"),
        F.size("attempts").cast("bigint").alias("n_attempts"), last["round"].alias("rounds"), US(last["end_ts"]).alias("end_us"), "state")


@query("delivery_report", """
    SELECT stream_name, shard_no, count(*) AS received, count(*) FILTER (done) AS delivered, count(*) FILTER (NOT done) AS failed,
           count(*) FILTER (NOT done AND last_code = 'Expired') AS expired, sum(tries - 1)::BIGINT AS retries,
           sum(buffered) / sum(tries)::BIGINT AS mean_buffering_ms, sum(CASE WHEN done THEN data_bytes ELSE 0 END)::BIGINT AS delivered_bytes
    FROM (SELECT source_id, stream_name, shard_no, any_value(data_bytes) AS data_bytes, bool_or(success) AS done, count(*) AS tries,
                 arg_max(coalesce(error_code, ''), attempt_no) AS last_code, sum(waited) AS buffered
          FROM (SELECT *, (epoch_us(start_ts) - epoch_us(coalesce(lag(end_ts) OVER (PARTITION BY source_id ORDER BY attempt_no), arrival_ts))) / 1000 AS waited FROM attempts)
          GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def delivery_report(spark, d):
    """Received, delivered, failed, expired, retries, buffering time and bytes per stream and shard."""
    timed = MT.buffering_time(fx.attempts(spark, d))
    per_record = timed.groupBy("source_id", "stream_name", "shard_no").agg(
        F.first("data_bytes").alias("data_bytes"), F.bool_or("success").alias("done"), F.count(F.lit(1)).alias("tries"),
        F.max_by(F.coalesce("error_code", F.lit("")), "attempt_no").alias("last_code"), F.sum("value").alias("buffered"))
    done = F.col("done")
    return per_record.groupBy("stream_name", "shard_no").agg(
        F.count(F.lit(1)).alias("received"), F.count_if(done).alias("delivered"), F.count_if(~done).alias("failed"),
        F.count_if(~done & (F.col("last_code") == O.EXPIRED[0])).alias("expired"), F.sum(F.col("tries") - 1).alias("retries"),
        (F.sum("buffered") / F.sum("tries")).alias("mean_buffering_ms"),
        F.sum(F.when(done, F.col("data_bytes")).otherwise(0)).alias("delivered_bytes"))

"""Queries over delivery results, attempts and retries."""
from __future__ import annotations

from pyspark.sql import functions as F

from sparkpack.functions.text import plus_ms
from sparkpack.operators import intake
from sparkpack.operators import outcomes as O
from sparkpack.plans.registry import query
from sparkpack.sources import fixtures as fx

US = F.unix_micros
CFG = fx.SCALED


def matched(spark, d):
    return O.match_results(fx.request_entries(spark, d), fx.requests(spark, d), fx.responses(spark, d))


def record_outcomes(spark, d):
    return O.record_outcome(O.entry_outcomes(matched(spark, d), CFG), fx.request_members(spark, d))


@query("match_results", """
    SELECT request_id, pos, action, mismatch, sequence_number, shard_id, error_code, coalesce(n_results, 0) AS n_results FROM matched""")
def match_results(spark, d):
    """Request entries with the response entry at the same position."""
    return matched(spark, d).select("request_id", "pos", "action", "mismatch", "sequence_number", "shard_id", "error_code",
                                    F.coalesce("n_results", F.lit(0)).alias("n_results"))


@query("correlate_results", """
    SELECT r.source_id, r.success, u.stream_name, u.source_id IS NOT NULL AS known FROM results r LEFT JOIN user_records u USING (source_id)""")
def correlate_results(spark, d):
    """Results with the record they belong to."""
    return O.correlate_results(fx.results(spark, d), fx.user_records(spark, d)).select("source_id", "success", "stream_name", "known")


@query("outstanding_records", """
    SELECT stream_name, count(*) AS n FROM user_records u WHERE NOT EXISTS (SELECT 1 FROM results r WHERE r.source_id = u.source_id) GROUP BY 1""")
def outstanding_records(spark, d):
    """Records without a result, per stream."""
    return O.outstanding_records(fx.user_records(spark, d), fx.results(spark, d)).groupBy("stream_name").agg(F.count(F.lit(1)).alias("n"))


@query("orphan_results", """
    SELECT source_id, success FROM results r WHERE NOT EXISTS (SELECT 1 FROM user_records u WHERE u.source_id = r.source_id)""")
def orphan_results(spark, d):
    """Results of unknown records."""
    return O.orphan_results(fx.results(spark, d), fx.user_records(spark, d)).select("source_id", "success")


@query("finished_records", """
    SELECT source_id, stream_name FROM user_records u WHERE EXISTS (SELECT 1 FROM results r WHERE r.source_id = u.source_id)""")
def finished_records(spark, d):
    """Records with a terminal result."""
    return O.finished_records(fx.user_records(spark, d), fx.results(spark, d)).select("source_id", "stream_name")


@query("wrong_shard", """
    SELECT m.stream_name, count(*) AS n, epoch_us(max(x.start_ts)) AS seen_us
    FROM matched x JOIN request_members m ON m.request_id = x.request_id AND m.pos = x.pos
    WHERE x.sequence_number IS NOT NULL AND split_part(x.shard_id, '-', 2)::BIGINT <> x.predicted_shard GROUP BY 1""")
def wrong_shard(spark, d):
    """Records stored in another shard than predicted, and when each stream's map was last seen to be wrong."""
    wrong = O.wrong_shard(matched(spark, d)).select("request_id", "pos", "start_ts")
    members = fx.request_members(spark, d).select("request_id", "pos", "stream_name")
    return O.map_invalidations(wrong.join(members, ["request_id", "pos"])).select("stream_name", "n", US("seen_at").alias("seen_us"))


@query("record_outcome", "SELECT source_id, stream_name, outcome, code, message, shard_id, sequence_number FROM record_outcomes")
def record_outcome(spark, d):
    """Finish, fail or retry for every user record."""
    return record_outcomes(spark, d).select("source_id", "stream_name", "outcome", "code", "message", "shard_id", "sequence_number")


ATTEMPT_TEXT = "CASE WHEN success THEN 'ok' ELSE error_code END"


@query("append_attempt", f"""
    SELECT source_id, count(*) + CASE WHEN bool_or(success) THEN 0 ELSE 1 END AS n_attempts,
           string_agg({ATTEMPT_TEXT}, '|' ORDER BY attempt_no) || CASE WHEN bool_or(success) THEN '' ELSE '|Expired' END AS history
    FROM attempts GROUP BY 1""")
def append_attempt(spark, d):
    """Histories of undelivered records extended by the final expiry."""
    results = O.put_record_result(fx.attempts(spark, d))
    last = F.element_at("attempts", -1)
    now = plus_ms(last["end_ts"], 1000)
    none = F.lit(None).cast("string")
    expired = F.struct(
        (last["attempt_no"] + 1).alias("attempt_no"), now.alias("start_ts"), now.alias("end_ts"), F.lit(False).alias("success"),
        F.lit(O.EXPIRED[0]).alias("error_code"), F.lit(O.EXPIRED[1]).alias("error_message"), none.alias("shard_id"), none.alias("sequence_number"))
    delivered, failed = results.filter("success"), O.append_attempt(results.filter("NOT success"), expired)
    text = F.array_join(F.transform("attempts", lambda a: F.when(a["success"], "ok").otherwise(a["error_code"])), "|")
    return delivered.unionByName(failed).select("source_id", F.size("attempts").cast("bigint").alias("n_attempts"), text.alias("history"))


@query("retry_set", """
    SELECT source_id, CASE WHEN expiration_ts < end_ts THEN 'fail' ELSE 'retry' END AS outcome,
           CASE WHEN expiration_ts < end_ts THEN 'Expired' ELSE code END AS code,
           CASE WHEN expiration_ts < end_ts THEN 'Record has reached expiration' ELSE message END AS message,
           code AS cause_code, message AS cause_message, code || CASE WHEN expiration_ts < end_ts THEN '|Expired' ELSE '' END AS history,
           CASE WHEN expiration_ts >= end_ts THEN epoch_us(least(end_ts + INTERVAL 3 HOUR, expiration_ts)) END AS deadline_us
    FROM record_outcomes WHERE outcome = 'retry'""")
def retry_set(spark, d):
    """Records to send again with their new deadline; expired ones fail."""
    return O.retry_set(record_outcomes(spark, d), CFG, F.col("end_ts")).select(
        "source_id", "outcome", "code", "message", "cause_code", "cause_message",
        F.array_join(F.transform("attempts", lambda a: a["error_code"]), "|").alias("history"), US("deadline_ts").alias("deadline_us"))


@query("union_retries", """
    SELECT stream_name, kind, count(*) AS n, epoch_us(min(deadline_ts)) AS first_us FROM (
      SELECT stream_name, 'retry' AS kind, least(end_ts + INTERVAL 3 HOUR, expiration_ts) AS deadline_ts
      FROM record_outcomes WHERE outcome = 'retry' AND expiration_ts >= end_ts
      UNION ALL SELECT stream_name, 'new', arrival_ts + INTERVAL 6 HOUR FROM user_records) GROUP BY 1, 2""")
def union_retries(spark, d):
    """Retried records re-enter together with new ones."""
    again = O.retry_set(record_outcomes(spark, d), CFG, F.col("end_ts")).filter("outcome = 'retry'").select(
        "stream_name", F.lit("retry").alias("kind"), "deadline_ts")
    new = intake.assign_times(fx.user_records(spark, d), CFG).select("stream_name", F.lit("new").alias("kind"), "deadline_ts")
    return again.unionByName(new).groupBy("stream_name", "kind").agg(F.count(F.lit(1)).alias("n"), US(F.min("deadline_ts")).alias("first_us"))


@query("attempt_timing", """
    SELECT source_id, attempt_no::BIGINT AS attempt_no,
           (epoch_us(start_ts) - epoch_us(coalesce(lag(end_ts) OVER (PARTITION BY source_id ORDER BY attempt_no), arrival_ts))) / 1000 AS delay_ms,
           (epoch_us(end_ts) - epoch_us(start_ts)) / 1000 AS duration_ms FROM attempts""")
def attempt_timing(spark, d):
    """Delay and duration of each attempt."""
    return O.attempt_timing(fx.attempts(spark, d)).select("source_id", F.col("attempt_no").cast("bigint").alias("attempt_no"), "delay_ms", "duration_ms")


@query("put_record_result", f"""
    SELECT source_id, string_agg({ATTEMPT_TEXT}, '|' ORDER BY attempt_no) AS history, bool_or(success) AS success,
           max(shard_id) AS shard_id, max(sequence_number) AS sequence_number FROM attempts GROUP BY 1""")
def put_record_result(spark, d):
    """One row per record with its attempts and where it was stored."""
    text = F.array_join(F.transform("attempts", lambda a: F.when(a["success"], "ok").otherwise(a["error_code"])), "|")
    return O.put_record_result(fx.attempts(spark, d)).select("source_id", text.alias("history"), "success", "shard_id", "sequence_number")


@query("final_attempt", """
    SELECT source_id, attempt_no::BIGINT AS attempt_no, success, error_code, epoch_us(end_ts) AS end_us FROM last_attempts""")
def final_attempt(spark, d):
    """Last attempt of each record."""
    return O.final_attempt(fx.attempts(spark, d)).select(
        "source_id", F.col("attempt_no").cast("bigint").alias("attempt_no"), "success", "error_code", US("end_ts").alias("end_us"))


@query("error_text_trim", """
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN substr(text, 1, 255) WHEN doc_id % 3 = 1 THEN 'Http' || (400 + doc_id % 200) END AS label,
           md5(substr(text, 1, 4096)) AS text_md5, length(substr(text, 1, 4096)) AS text_chars FROM documents""")
def error_text_trim(spark, d):
    """Error labels and texts cut to their limits."""
    k = F.col("source_id") % 3
    docs = fx.document_records(spark, d).withColumn("text", F.decode("data", "UTF-8"))
    status = F.when(k == 1, F.lit(400) + F.col("source_id") % 200).when(k == 2, 200)
    text = O.error_text(F.col("text"))
    return docs.select(
        F.col("source_id").alias("doc_id"), O.error_label(k == 0, status, F.col("text")).alias("label"),
        F.md5(text.cast("binary")).alias("text_md5"), F.length(text).cast("bigint").alias("text_chars"))

"""From service responses to per-record outcomes, retries and attempt histories."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.config import PackConfig
from sparkpack.functions.keys import shard_number
from sparkpack.functions.text import ms_between, plus_ms
from sparkpack.operators import intake

# fixed values: codes and texts of outcomes decided on our side
WRONG_SHARD = ("Wrong Shard", "Record did not end up in expected shard.")
EXPIRED = ("Expired", "Record has reached expiration")
COUNT_MISMATCH = "Record Count Mismatch"
MAX_ERROR_LABEL, MAX_ERROR_TEXT = 255, 4096


def match_results(entries: DataFrame, requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Join request entries and response entries by position; count entries on both sides per request."""
    answered = responses.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_results"))
    heads = intake.response_action(requests).join(answered, "request_id", "left")
    out = entries.join(heads, "request_id").join(responses, ["request_id", "pos"], "left")
    mismatch = (F.col("status") == 200) & (F.coalesce("n_results", F.lit(0)) != F.col("n_entries"))
    return out.withColumn("mismatch", F.coalesce(mismatch, F.lit(False)))


def entry_outcomes(matched: DataFrame, cfg: PackConfig) -> DataFrame:
    """success / retry / fail with code and message for each request entry."""
    action, seq = F.col("action"), F.col("sequence_number")
    wrong = seq.isNotNull() & is_wrong_shard(F.col("predicted_shard"), F.col("shard_id"))
    per_record = action == "per_record"
    outcome = (
        F.when(action == "retry", "retry").when((action == "fail") | F.col("mismatch"), "fail")
        .when(wrong, "retry").when(seq.isNotNull(), "success")
        .when(intake.can_retry(F.col("error_code"), cfg.fail_if_throttled), "retry").otherwise("fail")
    )
    code = (
        F.when(F.col("transport_error"), "Transport")
        .when(~per_record, http_label(F.col("status")))
        .when(F.col("mismatch"), COUNT_MISMATCH).when(wrong, WRONG_SHARD[0])
        .when(seq.isNotNull(), F.lit(None)).otherwise(F.col("error_code"))
    )
    counts = F.concat(F.coalesce("n_results", F.lit(0)).cast("string"), F.lit(" received, "),
                      F.col("n_entries").cast("string"), F.lit(" sent"))
    message = (
        F.when(F.col("transport_error"), F.col("error_text")).when(~per_record, F.lit(None))
        .when(F.col("mismatch"), counts).when(wrong, WRONG_SHARD[1])
        .when(seq.isNotNull(), F.lit(None)).otherwise(F.col("error_message"))
    )
    done = F.col("outcome") == "success"
    return matched.withColumns({"outcome": outcome, "code": code, "message": message}).withColumns({
        "shard_id": F.when(done, F.col("shard_id")), "sequence_number": F.when(done, seq)})


def record_outcome(outcomes: DataFrame, members: DataFrame) -> DataFrame:
    """Every user record inside an entry shares the entry's outcome."""
    keep = ["request_id", "pos", "outcome", "code", "message", "start_ts", "end_ts", "shard_id", "sequence_number"]
    return members.join(outcomes.select(*keep), ["request_id", "pos"])


def is_wrong_shard(predicted: Column, shard_id: Column) -> Column:
    return (predicted != -1) & (shard_number(shard_id) != predicted)


def wrong_shard(matched: DataFrame) -> DataFrame:
    """Entries that were stored, but not in the predicted shard."""
    return matched.filter(F.col("sequence_number").isNotNull() & is_wrong_shard(F.col("predicted_shard"), F.col("shard_id")))


def map_invalidations(wrong: DataFrame) -> DataFrame:
    """Latest time a stream's shard map was seen to be wrong."""
    return wrong.groupBy("stream_name").agg(F.max("start_ts").alias("seen_at"), F.count(F.lit(1)).alias("n"))


def retry_set(outcomes: DataFrame, cfg: PackConfig, now: Column) -> DataFrame:
    """Retried records with their new deadline and the attempts of this round; those past their expiration fail instead.

    attempts holds the error that led here and, where the record has expired, the expiry as a second one. cause_code and
    cause_message repeat the former.
    """
    expired = F.col("expiration_ts") < now
    due = F.least(plus_ms(now, cfg.record_max_buffered_ms // 2), F.col("expiration_ts"))
    start = F.col("start_ts") if "start_ts" in outcomes.columns else now

    def attempt(begin: Column, code: Column, message: Column) -> Column:
        return F.struct(begin.alias("start_ts"), now.alias("end_ts"), code.alias("error_code"), message.alias("error_message"))
    tried = F.array(attempt(start, F.col("code"), F.col("message")))
    gone = F.array(attempt(now, F.lit(EXPIRED[0]), F.lit(EXPIRED[1])))
    return outcomes.filter(F.col("outcome") == "retry").select(
        *[c for c in outcomes.columns if c not in ("outcome", "code", "message", "cause_code", "cause_message", "attempts")],
        F.col("code").alias("cause_code"), F.col("message").alias("cause_message"),
        F.when(expired, F.concat(tried, gone)).otherwise(tried).alias("attempts"),
        F.when(expired, "fail").otherwise("retry").alias("outcome"),
        F.when(expired, EXPIRED[0]).otherwise(F.col("code")).alias("code"),
        F.when(expired, EXPIRED[1]).otherwise(F.col("message")).alias("message"),
        F.when(~expired, due).alias("deadline_ts"),
    )


ATTEMPT_FIELDS = ["attempt_no", "start_ts", "end_ts", "success", "error_code", "error_message", "shard_id", "sequence_number"]


def append_attempt(records: DataFrame, attempt: Column) -> DataFrame:
    """Add one attempt struct to the end of each record's history."""
    return records.withColumn("attempts", F.array_append("attempts", attempt))


def attempt_timing(attempts: DataFrame) -> DataFrame:
    """Delay before each attempt (from arrival, then from the previous end) and its duration, in ms."""
    w = Window.partitionBy("source_id").orderBy("attempt_no")
    since = F.coalesce(F.lag("end_ts").over(w), F.col("arrival_ts"))
    return attempts.withColumns({
        "delay_ms": ms_between(since, F.col("start_ts")), "duration_ms": ms_between(F.col("start_ts"), F.col("end_ts"))})


def put_record_result(attempts: DataFrame) -> DataFrame:
    """One row per record: ordered attempts, success if any attempt succeeded, place of the last success."""
    won = F.when(F.col("success"), F.col("attempt_no"))
    return attempts.groupBy("source_id").agg(
        F.array_sort(F.collect_list(F.struct(*ATTEMPT_FIELDS))).alias("attempts"),
        F.bool_or("success").alias("success"),
        F.max_by("shard_id", won).alias("shard_id"),
        F.max_by("sequence_number", won).alias("sequence_number"),
    )


def final_attempt(attempts: DataFrame) -> DataFrame:
    """The last attempt of each record, kept by a map-side combined max_by."""
    others = [c for c in attempts.columns if c != "source_id"]
    return attempts.groupBy("source_id").agg(F.max_by(F.struct(*others), "attempt_no").alias("a")).select("source_id", "a.*")


def http_label(status: Column) -> Column:
    return F.concat(F.lit("Http"), status.cast("string"))


def error_label(transport_error: Column, status: Column, error_text: Column) -> Column:
    return F.when(transport_error, F.substring(error_text, 1, MAX_ERROR_LABEL)).when(status != 200, http_label(status))


def error_text(text: Column) -> Column:
    return F.substring(text, 1, MAX_ERROR_TEXT)


def correlate_results(results: DataFrame, records: DataFrame) -> DataFrame:
    """Results back to the records they belong to; a result without a record is an error."""
    known = records.select("source_id", "stream_name", F.lit(True).alias("known"))
    return results.join(known, "source_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def _ids(df: DataFrame) -> DataFrame:
    """Each id once: copies of one id are combined before the shuffle the join needs anyway."""
    return df.select("source_id").distinct()


def outstanding_records(records: DataFrame, results: DataFrame) -> DataFrame:
    return records.join(_ids(results), "source_id", "left_anti")


def orphan_results(results: DataFrame, records: DataFrame) -> DataFrame:
    return results.join(_ids(records), "source_id", "left_anti")


def finished_records(records: DataFrame, results: DataFrame) -> DataFrame:
    return records.join(_ids(results), "source_id", "left_semi")

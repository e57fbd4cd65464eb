"""Delivery to the end: what a round could not deliver is packed and sent again, until nothing is left."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpack.config import PackConfig
from sparkpack.functions.text import plus_ms
from sparkpack.operators import intake
from sparkpack.operators import outcomes as O
from sparkpack.operators.arrivals import fold_arrivals
from sparkpack.operators.fold import BatchRule
from sparkpack.operators.stage import materialize

KEYS = ["stream_name", "shard_no"]
PENDING = ["source_id", *KEYS, "size", "partition_key", "explicit_hash_key", "arrival_ts", "deadline_ts", "expiration_ts", "tries"]
#: One attempt: a request that carried the record, or its expiry.
ATTEMPT = ["source_id", "round", "attempt_no", "start_ts", "end_ts", "success", "error_code", "error_message"]


def retry_deadline(now: Column, expiration: Column, cfg: PackConfig) -> Column:
    """A retried record waits half as long as a new one, and not past its expiration."""
    return F.least(plus_ms(now, cfg.record_max_buffered_ms // 2), expiration)


def expiry(now: Column) -> dict[str, Column]:
    """The attempt that says a record has expired; it takes no time."""
    return {"start_ts": now, "end_ts": now, "success": F.lit(False), "error_code": F.lit(O.EXPIRED[0]), "error_message": F.lit(O.EXPIRED[1])}


def one_round(pending: DataFrame, rule: BatchRule, respond: Callable[[DataFrame, int], DataFrame], number: int, cfg: PackConfig) -> DataFrame:
    """Pending records with the attempt of this round: batch_id, start_ts, end_ts, outcome (success, retry, fail), code, message.

    Retried records mix with each other by arrival while their deadlines differ, so buffers are filled by arrival.
    """
    batches = fold_arrivals(pending, rule, size=F.col("size"), keys=KEYS, slice_ms=cfg.slice_ms)
    sent = batches.groupBy(*KEYS, "batch_id").agg(F.max("flush_us").alias("flush_us"), F.count(F.lit(1)).alias("n_records"))
    answered = respond(sent.withColumn("start_ts", F.timestamp_micros("flush_us")), number)
    members = batches.select(F.col("id").alias("source_id"), "batch_id").join(
        answered.select("batch_id", "start_ts", "end_ts", "outcome", "code", "message"), "batch_id")
    return pending.join(members, "source_id")


def deliver(records: DataFrame, respond: Callable[[DataFrame, int], DataFrame], cfg: PackConfig, rule: BatchRule) -> tuple[DataFrame, int]:
    """All attempts (ATTEMPT) of all records until each is delivered, failed or expired, and the number of rounds.

    records: routed records with their times; respond: from batches (batch_id, start_ts, n_records) and the round to the
    same with end_ts, outcome, code and message, end_ts later than start_ts. A retried record arrives again when its
    attempt ended. If it has expired by then, it gets two attempts: the error that led there, then the expiry.

    Rounds are stage tables and each reads only what is still pending. They end because time moves on with each attempt
    while expirations stay.
    """
    size = F.octet_length("data").cast("bigint").alias("size")
    pending = records.select("source_id", *KEYS, size, "partition_key", "explicit_hash_key", "arrival_ts", "deadline_ts", "expiration_ts",
                             F.lit(0).cast("bigint").alias("tries"))
    pending, number, attempts = materialize(pending), 0, None
    while not pending.isEmpty():
        number += 1
        tried = materialize(one_round(pending, rule, respond, number, cfg))
        now, again = F.col("end_ts"), F.col("outcome") == "retry"
        over = again & (F.col("expiration_ts") < now)
        own = tried.select("source_id", F.lit(number).cast("bigint").alias("round"), (F.col("tries") + 1).alias("attempt_no"), "start_ts", "end_ts",
                           (F.col("outcome") == "success").alias("success"), F.col("code").alias("error_code"), F.col("message").alias("error_message"))
        lost = tried.filter(over).select("source_id", F.lit(number).cast("bigint").alias("round"), (F.col("tries") + 2).alias("attempt_no"),
                                         *[c.alias(n) for n, c in expiry(now).items()])
        both = own.unionByName(lost).select(*ATTEMPT)
        attempts = both if attempts is None else attempts.unionByName(both)
        left = tried.filter(again & ~over).withColumns({"arrival_ts": now, "deadline_ts": retry_deadline(now, F.col("expiration_ts"), cfg), "tries": F.col("tries") + 1})
        pending = materialize(left.select(*PENDING))
    if attempts is None:
        empty = pending.select("source_id", F.lit(0).cast("bigint").alias("round"), F.col("tries").alias("attempt_no"), *[c.alias(n) for n, c in expiry(F.col("arrival_ts")).items()])
        attempts = empty.select(*ATTEMPT)
    return attempts, number


def final_states(attempts: DataFrame) -> DataFrame:
    """One row per record: its attempts in order, and delivered, failed or expired."""
    item = F.struct("attempt_no", "round", "start_ts", "end_ts", "success", "error_code", "error_message")
    out = attempts.groupBy("source_id").agg(F.array_sort(F.collect_list(item)).alias("attempts"))
    last = F.element_at("attempts", -1)
    state = F.when(last["success"], "delivered").when(last["error_code"] == O.EXPIRED[0], "expired").otherwise("failed")
    return out.withColumn("state", state)


def answer_by_code(batches: DataFrame, code: Column, message: Column, wrong_shard: Column, took_ms: Column, cfg: PackConfig) -> DataFrame:
    """A service's answer per batch: its error code or null, whether it stored the batch in another shard, and how long it took."""
    outcome = F.when(wrong_shard, "retry").when(code.isNull(), "success").when(intake.can_retry(code, cfg.fail_if_throttled), "retry").otherwise("fail")
    return batches.withColumns({
        "end_ts": plus_ms(F.col("start_ts"), took_ms), "outcome": outcome, "code": F.when(wrong_shard, O.WRONG_SHARD[0]).otherwise(code),
        "message": F.when(wrong_shard, O.WRONG_SHARD[1]).otherwise(message)})

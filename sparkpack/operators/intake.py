"""Validation, timing and keying of put records; predicates on delivery responses."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpack.config import PackConfig
from sparkpack.functions import keys as K
from sparkpack.functions.text import plus_ms

MAX_KEY_CHARS = 256
MAX_DATA_BYTES = 1024 * 1024

# fixed values: error codes that may be retried
THROTTLED = "ProvisionedThroughputExceededException"
ALWAYS_RETRY = ["InternalFailure", "ServiceUnavailable"]


# fixed values: what counts as white space around a stream name
BLANKS = " \t\n\r\x0b\x0c\x85\xa0"


def stream_name() -> Column:
    return F.trim(F.col("stream_name"), F.lit(BLANKS))


def reject_reason() -> Column:
    key, explicit = F.col("partition_key"), F.trim("explicit_hash_key")
    return (
        F.when(F.col("stream_name").isNull() | (stream_name() == ""), "stream")
        .when(key.isNull(), "key null")
        .when(~F.length(key).between(1, MAX_KEY_CHARS), "key length")
        .when(explicit.isNotNull() & ~explicit.rlike("^[0-9]+$"), "explicit key not a number")
        .when(explicit.isNotNull() & ~K.is_valid_hash_key(explicit), "explicit key out of range")
        .when(F.octet_length("data") > MAX_DATA_BYTES, "data too large")
    )


def validate_records(records: DataFrame) -> DataFrame:
    """Every record with the first rule it breaks; null means valid."""
    return records.withColumn("reject_reason", reject_reason())


def valid_records(records: DataFrame) -> DataFrame:
    return validate_records(records).filter("reject_reason IS NULL").drop("reject_reason").withColumns({
        "stream_name": stream_name(), "explicit_hash_key": K.strip_zeros(F.trim("explicit_hash_key"))})


def rejects_by_reason(records: DataFrame) -> DataFrame:
    return (
        validate_records(records).filter("reject_reason IS NOT NULL")
        .groupBy("stream_name", "reject_reason").agg(F.count(F.lit(1)).alias("n"))
    )


def assign_times(records: DataFrame, cfg: PackConfig) -> DataFrame:
    expiration = plus_ms(F.col("arrival_ts"), cfg.record_ttl_ms)
    deadline = plus_ms(F.col("arrival_ts"), cfg.record_max_buffered_ms)
    return records.withColumns({"deadline_ts": F.least(deadline, expiration), "expiration_ts": expiration})


def mark_expired(records: DataFrame, as_of: Column) -> DataFrame:
    return records.withColumn("expired", F.col("expiration_ts") < as_of)


def response_action(requests: DataFrame) -> DataFrame:
    """Request-level routing of a response."""
    status = F.col("status")
    action = (
        F.when(F.col("transport_error"), "retry").when(status == 200, "per_record")
        .when(status.between(500, 599), "retry").otherwise("fail")
    )
    return requests.withColumn("action", action)


def can_retry(error_code: Column, fail_if_throttled: bool) -> Column:
    codes = ALWAYS_RETRY if fail_if_throttled else [THROTTLED, *ALWAYS_RETRY]
    return F.coalesce(error_code.isin(codes), F.lit(False))

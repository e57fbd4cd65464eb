"""Scans and decoders: put records, mixed messages, shard pages, service responses, ordered reads."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkpack.functions import keys as K
from sparkpack.operators.scan import ranged_row_numbers

PUT_RECORD_SCHEMA = (
    "source_id long, stream_name string, partition_key string, explicit_hash_key string, "
    "data binary, arrival_ts timestamp"
)
SEQUENCE_DIGITS = 64


def read_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def put_records_scan(df: DataFrame) -> DataFrame:
    """Project any table holding the put-record columns onto the fixed schema."""
    types = [f.strip().split(" ") for f in PUT_RECORD_SCHEMA.split(",")]
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in types])


def message_route(messages: DataFrame) -> DataFrame:
    """Tag every message with the payload it carries."""
    kind = (
        F.when(F.col("put_record").isNotNull(), "put")
        .when(F.col("flush").isNotNull(), "flush")
        .when(F.col("metrics_request").isNotNull(), "metrics_request")
        .otherwise("unknown")
    )
    return messages.withColumn("kind", kind)


SHARD_PAGE_SCHEMA = (
    "StreamDescription struct<StreamName:string,StreamStatus:string,HasMoreShards:boolean,"
    "Shards:array<struct<ShardId:string,ParentShardId:string,HashKeyRange:struct<StartingHashKey:string,EndingHashKey:string>,"
    "SequenceNumberRange:struct<StartingSequenceNumber:string,EndingSequenceNumber:string>>>>"
)


def shard_pages_scan(pages: DataFrame, body: str = "body") -> DataFrame:
    """JSON pages of a stream description -> open shards. Pages of streams that are not ready are skipped."""
    d = F.from_json(F.col(body), SHARD_PAGE_SCHEMA)["StreamDescription"]
    return (
        pages.select(d.alias("d"))
        .filter(F.col("d.StreamStatus").isin("ACTIVE", "UPDATING"))
        .select(F.col("d.StreamName").alias("stream_name"), F.explode("d.Shards").alias("s"))
        .filter(F.col("s.SequenceNumberRange.EndingSequenceNumber").isNull())
        .select(
            "stream_name",
            K.shard_number(F.col("s.ShardId")).alias("shard_no"),
            K.pad_key(F.col("s.HashKeyRange.EndingHashKey")).alias("end_key"),
        )
    )


RESPONSE_SCHEMA = (
    "Records array<struct<SequenceNumber:string,ShardId:string,ErrorCode:string,ErrorMessage:string>>"
)


def parse_put_response(bodies: DataFrame, body: str = "body") -> DataFrame:
    """JSON response -> one row per entry; a response without entries keeps one row with a null position."""
    keep = [c for c in bodies.columns if c != body]
    return (
        bodies.select(*keep, F.posexplode_outer(F.from_json(F.col(body), RESPONSE_SCHEMA)["Records"]).alias("pos", "r"))
        .select(
            *keep, F.col("pos").cast("bigint").alias("pos"),
            F.col("r.SequenceNumber").alias("sequence_number"), F.col("r.ShardId").alias("shard_id"),
            F.col("r.ErrorCode").alias("error_code"), F.col("r.ErrorMessage").alias("error_message"),
        )
    )


def sequence_order(sequence_number: Column) -> Column:
    return F.lpad(sequence_number, SEQUENCE_DIGITS, "0")


def read_after_sequence(records: DataFrame, after: str, limit: int = 1000, shard: int | None = None) -> DataFrame:
    """Consumer read: the next `limit` records after a sequence number, of one shard or of each shard."""
    seq = sequence_order(F.col("sequence_number"))
    later = records.filter(seq > F.lit(after.rjust(SEQUENCE_DIGITS, "0")))
    if shard is not None:
        return later.filter(F.col("shard_no") == shard).orderBy(seq).limit(limit)
    w = Window.partitionBy("shard_no").orderBy(seq)
    return later.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit).drop("_rn")


def read_on(records: DataFrame, after: str, limit: int = 1000) -> DataFrame:
    """Consumer read to the end: every record after a sequence number, with the number of the page (from 0) that brings it."""
    seq = sequence_order(F.col("sequence_number"))
    later = records.filter(seq > F.lit(after.rjust(SEQUENCE_DIGITS, "0")))
    placed = ranged_row_numbers(later, ["shard_no"], [seq], "_place")
    return placed.withColumn("page", F.floor(F.col("_place") / limit).cast("bigint")).drop("_place")

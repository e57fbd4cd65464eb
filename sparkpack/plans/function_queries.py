"""Queries over the scalar functions."""
from __future__ import annotations

from pyspark.sql import functions as F

from sparkpack.functions import keys as K
from sparkpack.functions import metric_names as M
from sparkpack.functions import text as X
from sparkpack.plans.registry import query
from sparkpack.sources import fixtures as fx
from sparkpack.sources.scans import read_table


@query("fn_hash_key", """
    SELECT event_id, lpad(md5_number(props)::VARCHAR, 39, '0') AS little,
           lpad((('0x' || substr(md5(props), 1, 16))::UBIGINT::UHUGEINT * 18446744073709551616::UHUGEINT
                 + ('0x' || substr(md5(props), 17, 16))::UBIGINT::UHUGEINT)::VARCHAR, 39, '0') AS big
    FROM events""")
def fn_hash_key(spark, d):
    """MD5 as a 128-bit number in both byte orders."""
    return fx.events(spark, d).select(
        "event_id", K.hash_key(F.col("props")).alias("little"), K.hash_key(F.col("props"), "big").alias("big"))


@query("fn_md5", "SELECT doc_id, upper(md5(text)) AS md5_text, upper(md5(text)) AS raw_hex FROM documents")
def fn_md5(spark, d):
    """Digest of whole texts as upper-case text and as bytes."""
    return read_table(spark, d, "documents").select(
        "doc_id", K.md5_hex(F.col("text")).alias("md5_text"), F.hex(K.md5_raw(F.col("text"))).alias("raw_hex"))


@query("fn_verify_md5", "SELECT doc_id, doc_id % 3 <> 0 AS verified FROM documents")
def fn_verify_md5(spark, d):
    """Case-insensitive digest check; every third digest belongs to another text."""
    t = F.col("text")
    digest = F.when(F.col("doc_id") % 3 == 0, F.md5(F.concat(t, F.lit("!")).cast("binary"))).when(
        F.col("doc_id") % 3 == 1, K.md5_hex(t)).otherwise(F.md5(t.cast("binary")))
    return read_table(spark, d, "documents").select("doc_id", K.verify_md5(t, digest).alias("verified"))


@query("fn_shard_id", """
    SELECT event_id, 'shardId-' || lpad(event_id::VARCHAR, 12, '0') AS shard_id, event_id AS shard_no FROM events""")
def fn_shard_id(spark, d):
    """Shard number to name and back."""
    name = K.shard_name(F.col("event_id"))
    return fx.events(spark, d).select("event_id", name.alias("shard_id"), K.shard_number(name).alias("shard_no"))


@query("fn_split_on_first", """
    SELECT doc_id, CASE WHEN instr(text, '. ') > 1 THEN 2 ELSE 1 END AS parts,
           md5(CASE WHEN instr(text, '. ') > 1 THEN substr(text, 1, instr(text, '. ') - 1) ELSE text END) AS head_md5,
           CASE WHEN instr(text, '. ') > 1 THEN md5(substr(text, instr(text, '. ') + 2)) END AS tail_md5
    FROM documents""")
def fn_split_on_first(spark, d):
    """Split whole texts at the first delimiter."""
    parts = X.split_on_first(F.col("text"), ". ")
    return read_table(spark, d, "documents").select("doc_id", parts.alias("p")).select(
        "doc_id", F.size("p").alias("parts"), F.md5(F.element_at("p", 1).cast("binary")).alias("head_md5"),
        F.md5(F.get("p", 1).cast("binary")).alias("tail_md5"))


@query("fn_url_encode", """
    SELECT event_id, array_to_string(list_transform(string_split(
             replace(replace(replace(replace(replace(replace(url_encode(props || ' ~*!(' || event_type || ')'),
               '%20', '+'), '~', '%7E'), '%2A', '*'), '%21', '!'), '%28', '('), '%29', ')'), '%'),
             lambda p, i: CASE WHEN i = 1 THEN p ELSE lower(substr(p, 1, 2)) || substr(p, 3) END), '%') AS encoded
    FROM events""")
def fn_url_encode(spark, d):
    """Form URL encoding."""
    text = F.concat("props", F.lit(" ~*!("), "event_type", F.lit(")"))
    return fx.events(spark, d).select("event_id", X.form_url_encode(text).alias("encoded"))


@query("fn_format_time", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H%M%S') AS time
    FROM events""")
def fn_format_time(spark, d):
    """Time stamps as text."""
    ts = F.col("ts")
    return fx.events(spark, d).select(
        "event_id", X.iso_utc(ts).alias("iso"), X.date_part_text(ts).alias("day"), X.time_part_text(ts).alias("time"))


@query("fn_bytes", """
    SELECT event_id, hex(props || event_type) AS joined, event_id % 2 = 0 AS same FROM events""")
def fn_bytes(spark, d):
    """Concatenate and compare byte strings."""
    a, b = F.col("props").cast("binary"), F.col("event_type").cast("binary")
    other = F.when(F.col("event_id") % 2 == 0, F.concat(a, b)).otherwise(F.concat(b, a))
    return fx.events(spark, d).select("event_id", F.hex(F.concat(a, b)).alias("joined"), (F.concat(a, b) == other).alias("same"))


@query("fn_decode_utf8", "SELECT doc_id, text, length(text) AS n_chars FROM documents")
def fn_decode_utf8(spark, d):
    """Payload bytes back to text."""
    text = F.decode("data", "UTF-8")
    return fx.document_records(spark, d).select(F.col("source_id").alias("doc_id"), text.alias("text"), F.length(text).cast("bigint").alias("n_chars"))


@query("fn_is_aggregated", "SELECT doc_id, doc_id % 5 = 0 AND strlen(text) >= 0 AS packed FROM documents")
def fn_is_aggregated(spark, d):
    """Packed-record test: intact, wrong digest, wrong magic, too short, plain."""
    body = F.col("text").cast("binary")
    magic, digest = F.unhex(F.lit(K.MAGIC_HEX)), F.unhex(F.md5(body))
    k = F.col("doc_id") % 5
    data = (
        F.when(k == 0, F.concat(magic, body, digest)).when(k == 1, F.concat(magic, body, F.unhex(F.md5(digest))))
        .when(k == 2, F.concat(F.unhex(F.lit("00000000")), body, digest)).when(k == 3, magic).otherwise(body)
    )
    return read_table(spark, d, "documents").select("doc_id", K.is_packed(data).alias("packed"))


@query("fn_metric_key", r"""
    SELECT sample_id, hex(chr(0) || 'MetricName' || chr(1) || name
             || coalesce(chr(0) || 'ErrorCode' || chr(1) || error_code, '') || chr(0) || 'StreamName' || chr(1) || stream_name
             || coalesce(chr(0) || 'ShardId' || chr(1) || shard_id, '')) AS key_hex,
           CASE WHEN shard_id IS NULL THEN 'StreamName' ELSE 'ShardId' END AS last_key,
           CASE WHEN error_code IS NULL THEN 1 ELSE 2 END + CASE WHEN shard_id IS NULL THEN 0 ELSE 1 END AS n_left
    FROM metric_samples""")
def fn_metric_key(spark, d):
    """Canonical dimension text, the last dimension, and the rest."""
    dims = F.col("dims")
    return fx.metric_samples(spark, d).select(
        "sample_id", F.hex(M.dimension_key(dims)).alias("key_hex"), M.last_dimension(dims)["key"].alias("last_key"),
        F.size(M.without_last(dims)).alias("n_left"))


@query("fn_metric_unit", """
    SELECT sample_id, CASE WHEN sample_id % 10 = 0 THEN 'None' WHEN name = 'BufferingTime' THEN 'Milliseconds'
           WHEN name = 'UserRecordsDataPut' THEN 'Bytes' ELSE 'Count' END AS unit FROM metric_samples""")
def fn_metric_unit(spark, d):
    """Unit of each sample's metric; unknown names have none."""
    name = F.when(F.col("sample_id") % 10 == 0, F.concat("name", F.lit("?"))).otherwise(F.col("name"))
    return fx.metric_samples(spark, d).select("sample_id", M.metric_unit(name).alias("unit"))


@query("fn_metric_level", """
    SELECT sample_id, CASE WHEN name IN ('UserRecordsPut', 'ErrorsByCode', 'BufferingTime') THEN 1 ELSE 2 END AS level_rank,
           sample_id % 3 AS granularity_rank FROM metric_samples""")
def fn_metric_level(spark, d):
    """Level and granularity names as ranks."""
    names = F.element_at(F.array(*[F.lit(x) for x in ("Global", "stream", "SHARD")]), (F.col("sample_id") % 3 + 1).cast("int"))
    return fx.metric_samples(spark, d).select(
        "sample_id", M.level_rank(M.metric_level(F.col("name"))).alias("level_rank"),
        M.granularity_rank(names).cast("bigint").alias("granularity_rank"))

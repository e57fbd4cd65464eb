"""Packed records: sizes, key tables, encoder as Column expressions, and the decoder.

Layout: magic, then a protobuf message (1: key table, 2: explicit key table, 3: records with 1: key index,
2: explicit key index, 3: data), then the MD5 digest of the message. Both tables start with a placeholder,
so real indexes start at 1.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.functions import keys as K
from sparkpack.operators.fold import ENVELOPE, PLACEHOLDER, PLACEHOLDER_ESTIMATE, PLACEHOLDER_EXACT
from sparkpack.operators.scan import spread

AGGREGATE_KEY = "a"      # fixed value: partition key of a packed record


def varint_len(x: Column) -> Column:
    return F.when(x < 1 << 7, 1).when(x < 1 << 14, 2).when(x < 1 << 21, 3).when(x < 1 << 28, 4).otherwise(5)


def varint_hex(x: Column) -> Column:
    """Hex text of a protobuf varint below 2^35."""
    def byte(v: Column) -> Column:
        return F.lpad(F.lower(F.hex(v)), 2, "0")

    def groups(n: int) -> Column:
        parts = [F.shiftrightunsigned(x, 7 * i).bitwiseAND(127) for i in range(n)]
        return F.concat(*[byte(p.bitwiseOR(128)) for p in parts[:-1]], byte(parts[-1]))

    out = F.when(x < 1 << 7, groups(1))
    for n in (2, 3, 4):
        out = out.when(x < 1 << 7 * n, groups(n))
    return out.otherwise(groups(5))


def _text_hex(tag: str, text: Column) -> Column:
    return F.concat(F.lit(tag), varint_hex(F.octet_length(text).cast("bigint")), F.lower(F.hex(text.cast("binary"))))


def _tables(items: Column) -> tuple[Column, Column]:
    """Both key tables of a batch, placeholder first, in first-seen order."""
    placeholder = F.array(F.lit(PLACEHOLDER))
    return (
        F.array_distinct(F.concat(placeholder, F.transform(items, lambda r: r["pk"]))),
        F.array_distinct(F.concat(placeholder, F.array_compact(F.transform(items, lambda r: r["ehk"])))),
    )


def _indexes(r: Column, pks: Column, ehks: Column) -> tuple[Column, Column]:
    ehk = F.when(r["ehk"].isNull(), F.lit(0).cast("bigint")).otherwise(F.array_position(ehks, r["ehk"]) - 1)
    return F.array_position(pks, r["pk"]) - 1, ehk


def _record_hex(r: Column, pks: Column, ehks: Column) -> Column:
    pk, ehk = _indexes(r, pks, ehks)
    size = F.octet_length(r["data"]).cast("bigint")
    none = F.lit("")
    return F.concat(
        F.when(pk > 0, F.concat(F.lit("08"), varint_hex(pk))).otherwise(none),
        F.when(ehk > 0, F.concat(F.lit("10"), varint_hex(ehk))).otherwise(none),
        F.when(size > 0, F.concat(F.lit("1a"), varint_hex(size), F.lower(F.hex(r["data"])))).otherwise(none),
    )


def _record_size(r: Column, pks: Column, ehks: Column) -> Column:
    pk, ehk = _indexes(r, pks, ehks)
    size = F.octet_length(r["data"]).cast("bigint")
    return (
        F.when(pk > 0, F.lit(1) + varint_len(pk)).otherwise(0) + F.when(ehk > 0, F.lit(1) + varint_len(ehk)).otherwise(0)
        + F.when(size > 0, F.lit(1) + varint_len(size) + size).otherwise(0)
    ).cast("bigint")


def _framed_size(size: Column) -> Column:
    return (F.lit(1) + varint_len(size) + size).cast("bigint")


def _array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _message_size(items: Column, pks: Column, ehks: Column) -> Column:
    """Bytes of the message without encoding it."""
    keys = F.concat(F.transform(pks, F.octet_length), F.transform(ehks, F.octet_length))
    bodies = F.transform(items, lambda r: _record_size(r, pks, ehks))
    return _array_sum(F.transform(keys, lambda n: _framed_size(n.cast("bigint")))) + _array_sum(F.transform(bodies, _framed_size))


def _message_hex(items: Column, pks: Column, ehks: Column) -> Column:
    bodies = F.transform(items, lambda r: _record_hex(r, pks, ehks))
    return F.concat(
        F.array_join(F.transform(pks, lambda t: _text_hex("0a", t)), ""),
        F.array_join(F.transform(ehks, lambda t: _text_hex("12", t)), ""),
        F.array_join(F.transform(bodies, lambda b: F.concat(
            F.lit("1a"), varint_hex((F.length(b) / 2).cast("bigint")), b)), ""),
    )


def envelope(message: Column) -> Column:
    """Magic, message, digest."""
    return F.concat(F.unhex(F.lit(K.MAGIC_HEX)), message, F.unhex(F.md5(message)))


def aggregate_records(batched: DataFrame, batch: list[str]) -> DataFrame:
    """One row per batch: wire bytes, or the plain data of a batch of one.

    `batched` has put-record columns, hash_key, the three times and `pos`; a batch is bounded by the packing
    limits, so the collected group is small.
    """
    item = F.struct("pos", "source_id", F.col("partition_key").alias("pk"), F.col("explicit_hash_key").alias("ehk"), "data", "hash_key")
    grouped = spread(batched, *batch).groupBy(*batch).agg(
        F.array_sort(F.collect_list(item)).alias("items"),
        F.max("arrival_ts").alias("arrival_ts"), F.min("deadline_ts").alias("deadline_ts"), F.min("expiration_ts").alias("expiration_ts"))
    first, many = F.element_at("items", 1), F.size("items") > 1
    pks, ehks = _tables(F.col("items"))
    tables = grouped.withColumns({"_pks": pks, "_ehks": ehks})
    parts = F.col("items"), F.col("_pks"), F.col("_ehks")
    return tables.withColumn("_message", F.when(many, F.unhex(_message_hex(*parts)))).select(
        *batch,
        F.size("items").cast("bigint").alias("n_records"),
        many.alias("is_aggregated"),
        F.when(many, AGGREGATE_KEY).otherwise(first["pk"]).alias("partition_key"),
        K.strip_zeros(first["hash_key"]).alias("explicit_hash_key"),
        F.when(many, envelope(F.col("_message"))).otherwise(first["data"]).alias("data"),
        F.when(many, _message_size(*parts) + ENVELOPE).otherwise(F.octet_length(first["data"])).alias("exact_size"),
        F.transform("items", lambda r: r["source_id"]).alias("source_ids"),
        "arrival_ts", "deadline_ts", "expiration_ts",
    )


# -- sizes without packing ---------------------------------------------------------------------------------

def key_table(batched: DataFrame, batch: list[str], key: str = "partition_key") -> DataFrame:
    """Distinct keys of each batch with index (placeholder = 0) and number of uses, in first-seen order."""
    seen = batched.filter(F.col(key).isNotNull()).groupBy(*batch, key).agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("uses"))
    return seen.withColumn("key_index", F.row_number().over(Window.partitionBy(*batch).orderBy("first_pos")).cast("bigint"))


def _first_use(batch: list[str], key: str) -> Column:
    return F.col(key).isNotNull() & (F.row_number().over(Window.partitionBy(*batch, key).orderBy("pos")) == 1)


def estimated_size(batched: DataFrame, batch: list[str]) -> DataFrame:
    """Running size estimate after each record of a batch."""
    pk, ehk = F.col("partition_key"), F.col("explicit_hash_key")
    size = F.octet_length("data")
    step = (
        size + 3 + 2
        + F.when(F.col("_new_pk") & (pk != PLACEHOLDER), F.length(pk) + 3).otherwise(0)
        + F.when(ehk.isNotNull(), 2).otherwise(0)
        + F.when(F.col("_new_ehk"), F.length(ehk) + 3).otherwise(0)
    )
    w = Window.partitionBy(*batch).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    marked = batched.withColumns({"_new_pk": _first_use(batch, "partition_key"), "_new_ehk": _first_use(batch, "explicit_hash_key")})
    return marked.withColumn(
        "estimate", F.when(F.col("pos") == 0, size).otherwise(F.sum(step).over(w) + PLACEHOLDER_ESTIMATE).cast("bigint")
    ).drop("_new_pk", "_new_ehk")


def accurate_size(batched: DataFrame, batch: list[str]) -> DataFrame:
    """Exact packed size of each batch from key positions and varint lengths; nothing is encoded."""
    def table(key: str, index: str) -> DataFrame:
        return key_table(batched, batch, key).select(*batch, F.col(key).alias(f"_{key}"), F.col("key_index").alias(index), "first_pos")

    pk, ehk = table("partition_key", "_pk_index"), table("explicit_hash_key", "_ehk_index").withColumnRenamed("first_pos", "_ehk_first")
    full = (
        batched.join(pk.withColumnRenamed("_partition_key", "partition_key"), [*batch, "partition_key"])
        .join(ehk.withColumnRenamed("_explicit_hash_key", "explicit_hash_key"), [*batch, "explicit_hash_key"], "left")
    )
    size = F.octet_length("data").cast("bigint")
    body = F.lit(1) + varint_len(F.col("_pk_index")) + F.when(F.col("_ehk_index").isNull(), 0).otherwise(
        F.lit(1) + varint_len(F.col("_ehk_index"))) + F.when(size > 0, F.lit(1) + varint_len(size) + size).otherwise(0)
    def entry(key: str, first: str) -> Column:
        octets = F.octet_length(key)
        return F.when(F.col(first) == F.col("pos"), F.lit(1) + varint_len(octets) + octets).otherwise(0)
    record = F.lit(1) + varint_len(F.col("_body")) + F.col("_body") + entry("partition_key", "first_pos") + F.coalesce(
        entry("explicit_hash_key", "_ehk_first"), F.lit(0))
    return full.withColumn("_body", body).groupBy(*batch).agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(record).alias("_packed"), F.sum(size).alias("data_bytes")
    ).select(*batch, "n_records", F.when(F.col("n_records") == 1, F.col("data_bytes")).otherwise(
        F.col("_packed") + ENVELOPE + PLACEHOLDER_EXACT).alias("exact_size"))


def batch_deadlines(batched: DataFrame, batch: list[str]) -> DataFrame:
    return batched.groupBy(*batch).agg(F.min("deadline_ts").alias("deadline_ts"), F.min("expiration_ts").alias("expiration_ts"))


# -- decoder -----------------------------------------------------------------------------------------------

class _Malformed(Exception):
    pass


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while at < len(buf) and shift < 70:
        b = buf[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7
    raise _Malformed


def _fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) pairs of one protobuf message."""
    at = 0
    while at < len(buf):
        tag, at = _varint(buf, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(buf, at)
        elif kind in (1, 2, 5):
            size = 8 if kind == 1 else 4
            if kind == 2:
                size, at = _varint(buf, at)
            value, at = buf[at:at + size], at + size
            if at > len(buf):
                raise _Malformed
        else:
            raise _Malformed
        yield tag >> 3, value


def unpack(message: bytes) -> tuple[list[tuple[str, str | None, bytes]], str | None]:
    """Records of one message and, if an index points outside its table, what was wrong with the first bad one."""
    pks, ehks, records = [], [], []
    for number, value in _fields(message):
        if number in (1, 2):
            (pks if number == 1 else ehks).append(value.decode("utf-8"))
        elif number == 3:
            record = {1: 0, 2: 0, 3: b""}
            record.update((n, v) for n, v in _fields(value) if n in record)
            records.append(record)
    out = []
    for r in records:
        if r[1] >= len(pks):
            return out, f"key index {r[1]} outside a table of {len(pks)}"
        if r[2] >= len(ehks) and r[2] > 0:
            return out, f"explicit key index {r[2]} outside a table of {len(ehks)}"
        ehk = ehks[r[2]] if r[2] < len(ehks) else PLACEHOLDER
        out.append((pks[r[1]], None if ehk == PLACEHOLDER else ehk, r[3]))
    return out, None


#: User records, or bytes of packed data, that a task has unpacked when they leave.
PIECE_ROWS, PIECE_BYTES = 4096, 1 << 23

DECODED = "sub_sequence long, partition_key string, explicit_hash_key string, data binary, aggregated boolean, error string"


def _unpacked(keep: list[str]):
    """Packed rows of a task to their user records, a few thousand at a time: each repeats the other columns of its packed row."""
    head, tail = len(K.MAGIC_HEX) // 2, K.DIGEST_BYTES

    def piece(pdf: pd.DataFrame, rows: list[tuple], origin: list[int]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[f.split()[0] for f in DECODED.split(", ")])
        return pd.concat([pdf[keep].iloc[origin].reset_index(drop=True), out], axis=1)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, origin, size = [], [], 0
            for i, (key, data, is_packed) in enumerate(zip(pdf["partition_key"], pdf["data"], pdf["_packed"])):
                records, error = None, None
                if is_packed:
                    try:
                        records, error = unpack(bytes(data)[head:-tail])
                    except (_Malformed, UnicodeDecodeError, AttributeError, TypeError):
                        pass
                if records is None:
                    rows.append((0, key, None, data, False, None))
                else:
                    rows += [(n, *r, True, None) for n, r in enumerate(records)]
                    if error:
                        rows.append((len(records), None, None, None, True, error))
                origin += [i] * (len(rows) - len(origin))
                size += len(data) if data is not None else 0
                if len(rows) >= PIECE_ROWS or size >= PIECE_BYTES:
                    yield piece(pdf, rows, origin)
                    rows, origin, size = [], [], 0
            if rows:
                yield piece(pdf, rows, origin)
    return decode


def deaggregate(packed: DataFrame) -> DataFrame:
    """Packed rows to user records; rows that are not packed pass through with aggregated = false.

    Other columns (sequence number, arrival time, ...) are copied to every record. A bad index keeps the records
    before it and adds one row whose `error` is set and whose `sub_sequence` counts the kept records.
    """
    keep = [c for c in packed.columns if c not in ("partition_key", "data", "explicit_hash_key")]
    types = dict(packed.dtypes)
    ddl = ", ".join([f"`{c}` {types[c]}" for c in keep] + [DECODED])

    # the format test runs in Spark; a filter on it would be pushed below the (expensive) data column
    return packed.withColumn("_packed", F.coalesce(K.is_packed(F.col("data")), F.lit(False))).mapInPandas(_unpacked(keep), ddl)


def deaggregate_records(packed: DataFrame) -> DataFrame:
    return deaggregate(packed).filter("error IS NULL").drop("error")


def deaggregate_errors(packed: DataFrame) -> DataFrame:
    return deaggregate(packed).filter("error IS NOT NULL").withColumnRenamed("sub_sequence", "kept")

"""Hash keys, digests and shard names as Column expressions.

128-bit keys are 39-digit zero-padded text: the value range does not fit DECIMAL(38),
and padded text compares, sorts and range-joins in numeric order without Python.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the record format
KEY_DIGITS = 39
MAX_HASH_KEY = str(2**128 - 1)
MAGIC_HEX = "F3899AC2"
DIGEST_BYTES = 16
SHARD_PREFIX = "shardId-"
SHARD_DIGITS = 12


def _once(value: Column, use) -> Column:
    """`use(value)` with `value` computed once per row. Inside a conditional branch Spark does not share
    repeated subexpressions, and a digest feeds several parts of the number."""
    return F.element_at(F.transform(F.array(value), use), 1)


def digest_to_decimal(hex_digest: Column, byte_order: str = "little") -> Column:
    """A 128-bit hex digest as 39-digit decimal text: upper half times 2^64 plus lower half, in 9-digit limbs.

    Limb products stay below 10^18, so everything is LONG arithmetic.
    """
    base = 10**9
    t0, t1, t2 = (F.lit(2**64 // base**i % base) for i in range(3))

    def limbs(half: Column) -> list[Column]:
        digits = F.lpad(F.conv(half, 16, 10), 20, "0")
        return [F.substring(digits, at, n).cast("bigint") for at, n in ((12, 9), (3, 9), (1, 2))]

    def number(v: Column) -> Column:
        h0, h1, h2, l0, l1, l2 = (v[f"d{i}"] for i in range(6))
        rest = lambda x: F.call_function("div", x, F.lit(base))
        c0 = h0 * t0 + l0
        c1 = h1 * t0 + h0 * t1 + l1 + rest(c0)
        c2 = h2 * t0 + h1 * t1 + h0 * t2 + l2 + rest(c1)
        c3 = h2 * t1 + h1 * t2 + rest(c2)
        c4 = h2 * t2 + rest(c3)
        text = lambda x, n: F.lpad(x.cast("string"), n, "0")
        return F.concat(text(c4, 3), *[text(c % base, 9) for c in (c3, c2, c1, c0)])

    def parts(h: Column) -> Column:
        six = limbs(F.substring(h, 1, 16)) + limbs(F.substring(h, 17, 16))
        return F.struct(*[c.alias(f"d{i}") for i, c in enumerate(six)])

    if byte_order == "little":
        hex_digest = F.regexp_replace(F.reverse(hex_digest), "(.)(.)", "$2$1")
    return _once(_once(hex_digest, parts), number)


def hash_key(partition_key: Column, byte_order: str = "little") -> Column:
    return digest_to_decimal(F.md5(partition_key.cast("binary")), byte_order)


def pad_key(decimal_text: Column) -> Column:
    return F.lpad(decimal_text, KEY_DIGITS, "0")


def effective_hash_key(explicit_hash_key: Column, partition_key: Column) -> Column:
    """The explicit key if the record has one, else the hash of its partition key."""
    return F.when(explicit_hash_key.isNotNull(), pad_key(explicit_hash_key)).otherwise(hash_key(partition_key))


def strip_zeros(padded: Column) -> Column:
    """39-digit text back to plain decimal text."""
    return F.regexp_replace(padded, "^0+(?=.)", "")


def is_valid_hash_key(text: Column) -> Column:
    """True for a decimal integer in 0..2^128-1 (leading zeros allowed)."""
    digits = F.regexp_replace(text, "^0+(?=.)", "")
    return text.rlike("^[0-9]+$") & (F.length(digits) <= KEY_DIGITS) & (pad_key(digits) <= F.lit(MAX_HASH_KEY))


def md5_hex(value: Column) -> Column:
    return F.upper(F.md5(value.cast("binary")))


def md5_raw(value: Column) -> Column:
    return F.unhex(F.md5(value.cast("binary")))


def verify_md5(value: Column, digest_text: Column) -> Column:
    return F.md5(value.cast("binary")) == F.lower(digest_text)


def shard_name(shard_no: Column) -> Column:
    return F.concat(F.lit(SHARD_PREFIX), F.lpad(shard_no.cast("string"), SHARD_DIGITS, "0"))


def shard_number(name: Column) -> Column:
    """The number after the first dash; null for a name of another form."""
    return F.try_element_at(F.split(name, "-"), F.lit(2)).try_cast("bigint")


def is_packed(data: Column) -> Column:
    """Magic prefix, room for a digest, and a digest that matches the body."""
    size = F.octet_length(data)
    head = len(MAGIC_HEX) // 2
    body = F.substring(data, F.lit(head + 1), size - F.lit(head + DIGEST_BYTES))
    tail = F.substring(data, size - F.lit(DIGEST_BYTES - 1), F.lit(DIGEST_BYTES))
    return F.when(size < head + DIGEST_BYTES, F.lit(False)).otherwise(
        (F.hex(F.substring(data, 1, head)) == MAGIC_HEX) & (F.lower(F.hex(tail)) == F.md5(body))
    )

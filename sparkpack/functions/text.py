"""Text, time and byte helpers as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_on_first(text: Column, delim: str) -> Column:
    """Array of one or two parts; a delimiter at the very start (or none at all) does not split."""
    at = F.instr(text, delim)
    head = F.substring(text, F.lit(1), at - 1)
    tail = F.substring(text, at + len(delim), F.length(text))
    return F.when(at > 1, F.array(head, tail)).otherwise(F.array(text))


def form_url_encode(text: Column) -> Column:
    """Form encoding with lower-case escapes; `! ( )` stay as they are."""
    parts = F.split(F.url_encode(text), "%")
    lowered = F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(
        F.concat(F.lower(F.substring(p, 1, 2)), F.substring(p, F.lit(3), F.length(p)))))
    out = F.array_join(lowered, "%")
    for escape, char in (("%21", "!"), ("%28", "("), ("%29", ")")):
        out = F.replace(out, F.lit(escape), F.lit(char))
    return out


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_part_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def time_part_text(ts: Column) -> Column:
    return F.date_format(ts, "HHmmss")


def plus_ms(ts: Column, ms) -> Column:
    amount = F.lit(ms) if isinstance(ms, (int, float)) else ms
    return F.timestamp_micros(F.unix_micros(ts) + amount.cast("bigint") * 1000)


def ms_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 1000.0

"""Buffers filled in order of arrival and flushed in order of deadline.

`operators/batching.py` folds records whose order of arrival is their order of deadline, so a buffer is a range of rows. With mixed
deadlines it is not: a flush takes the most urgent records, and what it cuts off by count or size stays with records that
came before and after. Where a block of rows begins, any set of records may be waiting, so blocks can't list what they may
inherit. They guess instead:

1. the arrivals of each key are cut into blocks of equally many rows;
2. every block runs from an empty buffer and says what it leaves behind;
3. blocks whose guess differs from what the block before them left run again from that, until all guesses hold.

A wrong start is usually forgotten within a few flushes, so almost all blocks are right after the second round. By
induction the guesses that hold are those of a run in order.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpack.operators.fold import ENVELOPE, NEVER, PLACEHOLDER, PLACEHOLDER_ESTIMATE, PLACEHOLDER_EXACT, BatchRule
from sparkpack.operators.scan import ordered_scan, spread, time_slice
from sparkpack.operators.stage import materialize

#: Rows of a block; a task holds one block and the buffer it starts from.
BLOCK_ROWS = 20_000

_WAITING = ["due", "arr", "id", "size", "pk", "ehk", "burst", "burst_size", "cuts"]


def _varlen(x: int) -> int:
    n = 1
    while x >= 128:
        x >>= 7
        n += 1
    return n


def exact_sizes(rows: list[tuple], packed: bool) -> Iterator[int]:
    """Exact size of the batch up to each of its records."""
    if not packed:
        total = 0
        for r in rows:
            total += r[3]
            yield total
        return
    tables: tuple[dict, dict] = ({PLACEHOLDER: 0}, {PLACEHOLDER: 0})
    total = ENVELOPE + PLACEHOLDER_EXACT
    for i, r in enumerate(rows):
        size = r[3]
        body = 1 + _varlen(size) + size if size else 0
        for table, text in zip(tables, r[4:6]):
            if text is None:
                continue
            if text not in table:
                table[text] = len(table)
                n = len(text.encode())
                total += 1 + _varlen(n) + n
            if table[text]:
                body += 1 + _varlen(table[text])
        total += 1 + _varlen(body) + body
        yield total if i else size


class Buffer:
    """What waits for one key, and the sizes its triggers look at."""

    def __init__(self, rule: BatchRule, rows: list[tuple]):
        self.rule, self.rows, self.out = rule, [], []
        self._refill(rows)

    def _refill(self, rows: list[tuple]) -> None:
        self.rows, self.due = [], NEVER
        self.estimate, self.seen, self.bursts = PLACEHOLDER_ESTIMATE if self.rule.packed else 0, (set(), set()), {}
        for r in rows:
            self._count(r)

    def _count(self, r: tuple) -> None:
        self.rows.append(r)
        self.due = min(self.due, r[0])
        self.estimate += r[3]
        if self.rule.packed:
            self.estimate += 5 + (2 if r[5] is not None else 0)
            for seen, text in zip(self.seen, r[4:6]):
                if text is not None and text != PLACEHOLDER and text not in seen:
                    seen.add(text)
                    self.estimate += len(text) + 3
        if r[6] != -1:
            self.bursts[r[6]] = self.bursts.get(r[6], 0) + r[7]

    def add(self, r: tuple, flag: bool) -> None:
        """A record arrives; a trigger flushes at once."""
        self._count(r)
        rule, size = self.rule, r[3] if len(self.rows) == 1 else self.estimate
        reason = ("count" if len(self.rows) >= rule.count_limit else "size" if rule.size_limit != NEVER and size + rule.margin >= rule.size_limit
                  else "flag" if flag else "burst" if r[6] != -1 and self.bursts[r[6]] >= rule.burst_limit else None)
        if reason:
            self.flush(r[1], reason)

    def flush(self, when: int, reason: str) -> None:
        """The most urgent records leave as far as the limits allow, one at least; the rest waits on."""
        rows, rule = sorted(self.rows, key=lambda r: r[:3]), self.rule
        n = min(len(rows), rule.count_limit)
        if rule.size_limit != NEVER:
            fits = 0
            for size in exact_sizes(rows[:n], rule.packed):
                if size + rule.margin > rule.size_limit:
                    break
                fits += 1
            n = max(1, fits)
        self.out.append((rows[:n], when, reason))
        self._refill([(*r[:8], r[8] + 1) for r in rows[n:]])

    def timers(self, until: int, clock: int) -> None:
        """Deadlines before `until` fire, in order; one that had passed when its record came fires at the time `clock`."""
        while self.rows and self.rule.use_deadline and self.due < until:
            clock = max(self.due, clock)
            self.flush(clock, "deadline")


def _play(pdf: pd.DataFrame, rule: BatchRule) -> Buffer:
    """Run one block: rows with rn 0 are the buffer it starts from."""
    pdf = pdf.sort_values(["rn", "due", "arr", "id"], ignore_index=True)
    pdf = pdf.astype({"pk": object, "ehk": object})
    for c in ("pk", "ehk"):
        pdf[c] = pdf[c].where(pdf[c].notna(), None)
    rows = list(zip(*(pdf[c].tolist() for c in _WAITING)))
    begun = int((pdf["rn"] == 0).sum())
    buffer, flags = Buffer(rule, rows[:begun]), pdf["flag"].tolist()
    clock = max((r[1] for r in rows[:begun]), default=-NEVER)
    for r, flag in zip(rows[begun:], flags[begun:]):
        buffer.timers(r[1], clock)
        clock = r[1]
        buffer.add(r, flag)
    if bool((pdf["rn"] == pdf["n_total"]).any()):                   # the key's last block
        buffer.timers(NEVER, clock)
        while buffer.rows:
            buffer.flush(clock, "end")
    return buffer


def _name(rows: list[tuple]) -> str:
    return hashlib.md5(repr(sorted(rows, key=lambda r: r[:3])).encode()).hexdigest() if rows else ""


def _left(keys: list[str], rule: BatchRule):
    """What a block leaves behind, one row per waiting record, and one row that names what it began and ended with."""
    columns = [*keys, "_block", "began", "ended", *_WAITING]

    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        begun = pdf.loc[pdf["rn"] == 0, "began"]
        buffer = _play(pdf, rule)
        rest = sorted(buffer.rows, key=lambda r: r[:3])
        head = (*key, begun.iloc[0] if len(begun) else "", _name(rest), *[None] * len(_WAITING))
        return pd.DataFrame([head, *((*key, None, None, *r) for r in rest)], columns=columns, dtype=object)
    return fn


def _batches(keys: list[str], rule: BatchRule):
    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(*key[: len(keys)], r[2], rows[0][2], i, when, reason, r[8]) for rows, when, reason in _play(pdf, rule).out for i, r in enumerate(rows)]
        return pd.DataFrame(out, columns=[*keys, "id", "batch_id", "pos", "flush_us", "reason", "cuts"])
    return fn


def fold_arrivals(
    records: DataFrame, rule: BatchRule, *, size: Column, keys: list[str], id_col: str = "source_id", slice_ms: int,
    flag: Column | None = None, burst_key: Column | None = None, burst_size: Column | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Assign every record to a batch: (keys, id, batch_id, pos, flush_us, reason, cuts).

    Records arrive by (arrival_ts, id) and leave by (deadline_ts, arrival_ts, id). batch_id is the id of a batch's first
    record; cuts tells how many flushes left the record behind. No record leaves before it came. burst_size (else size) is
    what a shard's share is measured by. keys and ids must not be null.
    """
    types = dict(records.dtypes)
    key_ddl, kind = ", ".join(f"{k} {types[k]}" for k in keys), types[id_col]
    waiting = f"due long, arr long, id {kind}, size long, pk string, ehk string, burst long, burst_size long, cuts long"
    none = F.lit(None).cast("string")
    slim = records.select(
        *keys, "arrival_ts", F.unix_micros("deadline_ts").alias("due"), F.unix_micros("arrival_ts").alias("arr"), F.col(id_col).alias("id"),
        size.cast("bigint").alias("size"), (F.col("partition_key") if rule.packed else none).alias("pk"),
        (F.col("explicit_hash_key") if rule.packed else none).alias("ehk"), (burst_key if burst_key is not None else F.lit(-1)).cast("bigint").alias("burst"),
        (burst_size if burst_size is not None else size).cast("bigint").alias("burst_size"), F.lit(0).cast("bigint").alias("cuts"),
        F.coalesce(flag, F.lit(False)).alias("flag") if flag is not None else F.lit(False).alias("flag"))
    numbered = ordered_scan(slim, keys, time_slice(F.col("arrival_ts"), slice_ms), [F.col("arrival_ts"), F.col("id")],
                            sums={"rn": F.lit(1).cast("bigint")}, totals={"n_total": F.lit(1).cast("bigint")})
    block = F.floor((F.col("rn") - 1) / block_rows).cast("bigint")
    rows = numbered.drop("arrival_ts").withColumn("_block", block).withColumn("began", none)
    by = [*keys, "_block"]
    rows = materialize(spread(rows, *by))

    def entries(state: DataFrame) -> DataFrame:
        """What each block left, as the first rows of the next one."""
        names = state.filter("ended IS NOT NULL").select(*by, F.col("ended").alias("_ended"))
        left = state.filter("ended IS NULL").drop("began", "ended").join(names, by)
        return left.select(*keys, (F.col("_block") + 1).alias("_block"), *_WAITING, F.col("_ended").alias("began"),
                           F.lit(False).alias("flag"), F.lit(0).cast("bigint").alias("rn"), F.lit(-1).cast("bigint").alias("n_total"))

    run = lambda some: some.groupBy(*by).applyInPandas(
        _left(keys, rule), f"{key_ddl}, _block long, began string, ended string, {waiting}")
    state = materialize(run(rows))
    while True:
        names = state.filter("ended IS NOT NULL").select(*by, "began", "ended")
        before = names.select(*keys, (F.col("_block") + 1).alias("_block"), F.col("ended").alias("_before"))
        wrong = materialize(names.join(before, by).filter("began <> _before").select(*by))
        if wrong.isEmpty():
            break
        again = rows.join(wrong, by, "left_semi").unionByName(entries(state).join(wrong, by, "left_semi"))
        state = materialize(state.join(wrong, by, "left_anti").unionByName(run(again)))
    held = rows.select(*by).distinct()
    all_rows = rows.unionByName(entries(state).join(held, by, "left_semi"))
    return all_rows.groupBy(*by).applyInPandas(
        _batches(keys, rule), f"{key_ddl}, id {kind}, batch_id {kind}, pos long, flush_us long, reason string, cuts long")

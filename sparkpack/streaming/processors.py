"""Stateful processors: packing with deadlines that fire by the event clock and flush commands, and rate limiting."""
from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sparkpack.operators.fold import NEVER, BatchRule, Stretch
from sparkpack.operators.shaping import EPOCH_S, LOW, Bucket
from sparkpack.streaming.clock import event_clock

_ROW = ["id", "size", "arrival_us", "deadline_us", "flag", "pk", "ehk", "burst_key", "late"]
_BUFFER = "id long, size long, arrival_us long, deadline_us long, flag boolean, pk string, ehk string, burst_key long, late boolean"
PACKED = "stream_name string, shard_no long, id long, batch_rn long, pos long, flush_us long, reason string, late boolean"

#: When a stream's clock is moved to its end: 2100-01-01. Buffers without deadlines leave then.
END_US = 4_102_444_800_000_000


#: Rows of a key that are laid out for the search of flushes, or pass to and from its state, at once.
PIECE = 1 << 16
_NUMBERS = {"id": np.int64, "size": np.int64, "arrival_us": np.int64, "deadline_us": np.int64, "flag": bool, "burst_key": np.int64, "late": bool}
_NARROW = ["id", "size", "burst_key"]
_TEXTS = ["pk", "ehk"]


class _Columns:
    """Rows of one key as plain arrays that grow in place: numbers as wide as they need, texts as codes into an Arrow array."""

    def __init__(self):
        self.n = 0
        self.data = {c: np.zeros(0, np.int8 if c in _NARROW else _NUMBERS.get(c, np.int32)) for c in [*_NUMBERS, *_TEXTS]}
        self.names = {c: [pa.array([], pa.large_string())] for c in _TEXTS}
        self.distinct = dict.fromkeys(_TEXTS, 0)

    def __len__(self) -> int:
        return self.n

    def _resize(self, room: int) -> None:
        for values in self.data.values():
            values.resize(room, refcheck=False)

    def add(self, pdf: pd.DataFrame) -> None:
        lo, self.n = self.n, self.n + len(pdf)
        if self.n > len(self.data["id"]):
            self._resize(self.n + self.n // 8)
        for c, kind in _NUMBERS.items():
            values = pdf[c].to_numpy(kind)
            if c in _NARROW and len(values):
                self._widen(c, int(values.min()), int(values.max()))
            self.data[c][lo:self.n] = values
        for c in _TEXTS:
            part, names = pa.array(pdf[c].astype(object), pa.large_string(), from_pandas=True).dictionary_encode(), self.names[c]
            known = sum(map(len, names))
            codes = part.indices.fill_null(-1).to_numpy()
            self.data[c][lo:self.n] = np.where(codes < 0, -1, codes + known)
            names.append(part.dictionary)
            if known + len(part.dictionary) > 2 * self.distinct[c] + PIECE:
                self._merge(c)

    def _widen(self, c: str, least: int, most: int) -> None:
        fits = next(k for k in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(k).min <= least and most <= np.iinfo(k).max)
        if np.dtype(fits).itemsize > self.data[c].itemsize:
            self.data[c] = self.data[c].astype(fits)

    def _merge(self, c: str) -> None:
        """Texts that came with several parts get one code."""
        every = pa.concat_arrays(self.names[c]).dictionary_encode()
        codes = self.data[c][:self.n]
        codes[:] = np.append(every.indices.to_numpy(), np.int32(-1))[codes]
        self.names[c], self.distinct[c] = [every.dictionary], len(every.dictionary)

    def close(self) -> None:
        """No more rows."""
        self._resize(self.n)
        self.names = {c: [pa.concat_arrays(names)] for c, names in self.names.items()}

    def sort(self, first: int) -> None:
        """Order the rows from `first` on; those before stay."""
        by = np.lexsort([self.data[c][first:] for c in ("id", "arrival_us", "deadline_us")])
        by += first
        for values in self.data.values():
            values[first:] = values[by]

    def _texts(self, c: str, lo: int, hi: int) -> np.ndarray:
        codes = self.data[c][lo:hi]
        return self.names[c][0].take(pa.array(codes, mask=codes < 0)).to_numpy(zero_copy_only=False)

    def frame(self, lo: int, hi: int) -> pd.DataFrame:
        part = {c: self.data[c][lo:hi] for c in _NUMBERS} | {c: self._texts(c, lo, hi) for c in _TEXTS}
        return pd.DataFrame(part)[_ROW]


class PackProcessor(StatefulProcessor):
    """Buffers records per key. Rows of a micro-batch are ordered here and deadlines are replayed between them; a timer at the
    earliest deadline that waits flushes a key that falls silent. Flush rows empty the buffer.

    A row behind the event clock or behind rows handled before it arrives now and is marked late: its arrival becomes the
    newest time its key has seen and its deadline no earlier than those waiting, so it is flushed after it came and never
    ahead of the buffer's order.

    A micro-batch of a key is held as arrays of numbers; flushes are searched and leave piece by piece.
    """

    def __init__(self, rule: BatchRule):
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", _BUFFER)
        self.first = handle.getValueState("first", "rn long, clock long")
        self.timer = handle.getValueState("timer", "ms long")

    def _load(self) -> tuple[_Columns, int, int]:
        cols = _Columns()
        if self.buffer.exists():
            stored = map(tuple, self.buffer.get())
            while part := list(islice(stored, PIECE)):
                cols.add(pd.DataFrame(part, columns=_ROW))
        rn, clock = self.first.get() if self.first.exists() else (1, -NEVER)
        return cols, rn, clock

    def _store(self, rows: _Columns, s: int, rn: int, clock: int) -> None:
        """Rows from `s` on wait."""
        wanted = None
        for lo in range(s, len(rows), PIECE):
            rest = rows.frame(lo, min(lo + PIECE, len(rows)))
            plain = rest.astype(object).where(rest.notna(), None)
            keep = self.buffer.put if lo == s else self.buffer.appendList
            keep(list(plain.itertuples(index=False, name=None)))
        if s < len(rows):
            wanted = (int(rows.data["deadline_us"][s]) if self.rule.use_deadline else END_US) // 1000 + 1
        else:
            self.buffer.clear()
        self.first.update((rn, clock))
        have = self.timer.get()[0] if self.timer.exists() else None
        if have != wanted:
            if have is not None:
                self.handle.deleteTimer(have)
                self.timer.clear()
            if wanted is not None:
                self.handle.registerTimer(wanted)
                self.timer.update((wanted,))

    def _rows(self, key, rows: _Columns, rn: int, flushes: list[tuple[int, int, int, str]]) -> pd.DataFrame:
        begin, end = flushes[0][0], flushes[-1][1]
        lengths = [e - b for b, e, _, _ in flushes]
        out = pd.DataFrame({"id": rows.data["id"][begin:end].astype(np.int64), "late": rows.data["late"][begin:end]})
        first = np.repeat(np.array([b for b, _, _, _ in flushes], np.int64), lengths)
        out["stream_name"], out["shard_no"], out["batch_rn"], out["pos"] = key[0], key[1], rn + first, np.arange(begin, end) - first
        out["flush_us"] = np.repeat(np.array([w for _, _, w, _ in flushes], np.int64), lengths)
        out["reason"] = np.repeat(np.array([r for _, _, _, r in flushes], object), lengths)
        return out[[c.split()[0] for c in PACKED.split(", ")]]

    def _flush(self, key, rows: _Columns, buffered: int, rn: int, until: int, clock: int, forced=()) -> Iterator[pd.DataFrame]:
        """Flushes of ordered rows of which the first `buffered` were there before, and timers before `until`; `forced` are
        (position, time) commands. What is left is stored.

        A buffer [s, j) lies in the piece [base, top); records up to the next stop are added, and when the piece is used up the
        next one begins at s. A piece is at least twice its buffer, so a buffer without a bound is not read again too often.
        """
        s, j, n, base, top, st, flushes = 0, buffered, len(rows), 0, 0, None, []
        for at, when in [*forced, (n, None)]:
            while j < at or st is None:
                if st is None or j >= top:
                    if flushes:
                        yield self._rows(key, rows, rn, flushes)
                        flushes = []
                    base, top = s, min(n, max(j + PIECE, 2 * j - s))
                    st = Stretch(rows.frame(base, top), self.rule)
                stop, found = min(max(at, j), top), []
                s = base + st.run(s - base, j - base, stop - base, -NEVER, None, found)
                flushes += [(base + b, base + e, w, r) for b, e, w, r in found]
                j = stop
            found, due = [], until if when is None else when if self.rule.use_deadline else -NEVER
            s = base + st.run(s - base, j - base, at - base, due, None, found)
            flushes += [(base + b, base + e, w, r) for b, e, w, r in found]
            while when is not None and s < at:
                e = base + st.prefix(s - base, at - base)
                flushes.append((s, e, when, "flush"))
                s = e
        self._store(rows, s, rn + s, clock)
        yield self._rows(key, rows, rn, flushes or [(0, 0, 0, "")])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        merged, rn, clock = self._load()
        waiting = len(merged)
        now = timerValues.getCurrentWatermarkInMs() * 1000
        clock = max(clock, now) if now > 0 else clock
        commands = []
        for pdf in rows:
            put = pdf["kind"] == "put"
            commands += pdf.loc[pdf["kind"] == "flush", "arrival_us"].tolist()
            merged.add(pdf[put].assign(late=False))
        merged.close()
        arrival, deadline, late = (merged.data[c] for c in ("arrival_us", "deadline_us", "late"))
        late[waiting:] = arrival[waiting:] < clock
        behind = waiting + np.flatnonzero(late[waiting:])
        if len(behind):
            floor = int(deadline[:waiting].max()) if waiting else clock
            deadline[behind] = np.maximum(deadline[behind], max(floor, clock))
            arrival[behind] = clock
        merged.sort(waiting)
        commands = sorted(max(clock, int(c)) for c in commands)
        clock = max([clock, *([int(arrival[waiting:].max())] if len(merged) > waiting else []), *commands[-1:]])
        seen = np.searchsorted(np.sort(arrival), np.array(commands, np.int64), "right") if commands else []
        forced = [(max(waiting, int(k)), c) for k, c in zip(seen, commands)]
        yield from self._flush(key, merged, waiting, rn, now if now > 0 else -NEVER, int(clock), forced)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The earliest deadline has passed and nothing came."""
        self.timer.clear()
        waiting, rn, clock = self._load()
        waiting.close()
        until = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) * 1000
        forced = () if self.rule.use_deadline else ((len(waiting), END_US),)
        yield from self._flush(key, waiting, len(waiting), rn, until, clock, forced)

    def close(self) -> None:
        pass


def stream_pack(records: DataFrame, rule: BatchRule, flushes: DataFrame | None = None, ticks: DataFrame | None = None,
                lateness: str = "0 seconds") -> DataFrame:
    """Batches of a stream of routed records with times; `flushes` has stream_name, shard_no, flush_ts, `ticks` has ts.

    The event clock follows the arrivals of all keys, `lateness` behind; a key without new rows flushes when it passes its
    earliest deadline. No row is dropped for being late. `runner.run_and_close` ends a stream by moving the clock past every
    deadline.
    """
    at = F.col("arrival_ts")
    rows = records.select(
        "stream_name", "shard_no", F.lit("put").alias("kind"), at.alias("ts"), F.col("source_id").alias("id"),
        F.octet_length("data").cast("bigint").alias("size"), F.unix_micros(at).alias("arrival_us"),
        F.unix_micros("deadline_ts").alias("deadline_us"), F.lit(False).alias("flag"),
        F.col("partition_key").alias("pk"), F.col("explicit_hash_key").alias("ehk"), F.lit(-1).cast("bigint").alias("burst_key"))
    if flushes is not None:
        micros = F.unix_micros("flush_ts")
        rows = rows.unionByName(flushes.select(
            "stream_name", "shard_no", F.lit("flush").alias("kind"), F.col("flush_ts").alias("ts"), micros.alias("arrival_us"),
            micros.alias("deadline_us")), allowMissingColumns=True)
    if ticks is not None:
        rows = rows.unionByName(ticks.select(F.lit("tick").alias("kind"), "ts"), allowMissingColumns=True)
    # no nulls in numbers: pandas would make them floats
    whole = {c: F.coalesce(F.col(c), F.lit(-1).cast("bigint")) for c in ("id", "size", "arrival_us", "deadline_us", "burst_key")}
    rows = rows.withColumns(whole | {"flag": F.coalesce("flag", F.lit(False))})
    rows = event_clock(rows, F.col("ts"), lateness, F.col("kind") == "tick").drop("ts")
    return rows.groupBy("stream_name", "shard_no").transformWithStateInPandas(PackProcessor(rule), PACKED, "Append", "EventTime")


SHAPED = "stream_name string, shard_no long, source_id long, send_s double, expired boolean"


class LimitProcessor(StatefulProcessor):
    """Keeps when each of two token buckets is full again; send times are computed, nothing sleeps."""

    def __init__(self, per_record: Bucket, per_byte: Bucket, expire: bool):
        self.b1, self.b2, self.expire = per_record, per_byte, expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.full = handle.getValueState("full", "t1 double, t2 double, hold double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["deadline_us", "arrival_us", "source_id"])
        t1, t2, hold = self.full.get() if self.full.exists() else (LOW, LOW, LOW)
        out = []
        for sid, size, a, exp in zip(pdf["source_id"], pdf["size"], (pdf["arrival_us"] - EPOCH_S * 1_000_000) / 1e6, (pdf["expire_us"] - EPOCH_S * 1_000_000) / 1e6):
            c1, c2 = 1.0 / self.b1.rate, size / self.b2.rate
            send = max(a, hold, t1 + c1 - self.b1.depth, t2 + c2 - self.b2.depth)
            late = self.expire and (send > exp or size > self.b2.capacity)
            if late:
                hold = max(hold, exp)
            else:
                t1, t2 = max(t1, send) + c1, max(t2, send) + c2
            out.append((*key, int(sid), None if late else float(send), late))
        self.full.update((float(t1), float(t2), float(hold)))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in SHAPED.split(", ")])

    def close(self) -> None:
        pass


def stream_rate_limit(records: DataFrame, per_record: Bucket, per_byte: Bucket, expire: bool = True) -> DataFrame:
    rows = records.select(
        "stream_name", "shard_no", "source_id", F.octet_length("data").cast("bigint").alias("size"),
        F.unix_micros("arrival_ts").alias("arrival_us"), F.unix_micros("deadline_ts").alias("deadline_us"),
        F.unix_micros("expiration_ts").alias("expire_us"))
    return rows.groupBy("stream_name", "shard_no").transformWithStateInPandas(
        LimitProcessor(per_record, per_byte, expire), SHAPED, "Append", "None")

"""Outcomes of records whose puts and results arrive as one stream, in any order.

Every call into a stateful operator and its state costs about a millisecond, so a call handles many records: rows are
grouped by a hash of the record id, and the state of such a bucket is one packed array.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sparkpack.streaming.clock import event_clock

OUTCOMES = "source_id long, outcome string, at_us long"
_COLUMNS = [c.split()[0] for c in OUTCOMES.split(", ")]
#: Groups the records of a stream are dealt over; a stateful query must keep its number.
BUCKETS = 1024
#: Stands for a null id or time inside the state; pandas would make floats of columns with nulls.
NONE, NEVER = -(2**63), 2**63 - 1
PUT, RESULT, DONE = 0, 1, 2
#: Rows of a bucket's state: a put, a result that waits, or that the record has its outcome; each with its record's timer.
STATE = np.dtype([("id", "<i8"), ("what", "i1"), ("at", "<i8"), ("ok", "?"), ("wake", "<i8")])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("source_id"), F.lit(buckets)).cast("int").alias("bucket")


def _whole(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(NONE).cast("bigint")).alias(c)


def _with_nulls(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.when(F.col(c) != F.lit(NONE).cast("bigint"), F.col(c)) for c in columns})


def _ceil_ms(us: np.ndarray) -> np.ndarray:
    return -(-np.maximum(us, -NEVER) // 1000)


def settle(state: np.ndarray, new: np.ndarray, ttl: int, keep: int, now: int) -> tuple[np.ndarray, list[tuple]]:
    """State after new rows, and (id, outcome, at) of the records they decide; ttl in microseconds, keep and now in milliseconds."""
    new = new[~np.isin(new["id"], state["id"][state["what"] == DONE])]
    if not len(new):
        return state, []
    met = np.isin(state["id"], new["id"])
    rows = np.concatenate([state[met], new])
    ids, of = np.unique(rows["id"], return_inverse=True)
    put, at = rows["what"] == PUT, rows["at"]
    arrival, has_put = np.full(len(ids), NEVER), np.zeros(len(ids), bool)
    timed = put & (at != NONE)
    np.minimum.at(arrival, of[timed], at[timed])
    has_put[of[put]] = True
    own = arrival[of]
    fits = np.flatnonzero(~put & (at != NONE) & (own != NEVER) & (own <= at) & (at - own <= ttl))
    fits = fits[np.lexsort((~rows["ok"][fits], at[fits], of[fits]))]
    decided, first = np.unique(of[fits], return_index=True)
    best = rows[fits[first]]
    latest = np.full(len(ids), NONE)
    np.maximum.at(latest, of[~put], at[~put])
    limit = np.where(arrival != NEVER, np.minimum(arrival, NEVER - ttl) + ttl, NONE)
    wake = np.where(has_put, np.maximum(now, limit // 1000) + 1, np.maximum(now, _ceil_ms(latest)) + keep)
    rows["wake"] = wake[of]
    best["what"], best["wake"] = DONE, np.maximum(now, _ceil_ms(best["at"])) + keep
    open_ = ~np.isin(of, decided)
    puts = np.zeros(int(has_put.sum()), STATE)
    puts["id"], puts["what"], puts["at"], puts["wake"] = ids[has_put], PUT, np.where(arrival == NEVER, NONE, arrival)[has_put], wake[has_put]
    puts = puts[~np.isin(puts["id"], best["id"])]
    out = [(i, "delivered" if ok else "failed", t) for i, ok, t in zip(best["id"].tolist(), best["ok"].tolist(), best["at"].tolist())]
    return np.concatenate([state[~met], puts, rows[open_ & ~put], best]), out


def expire(state: np.ndarray, ttl: int, keep: int, now: int) -> tuple[np.ndarray, list[tuple]]:
    """State after the timers before now, and (id, outcome, at) of the records they decide."""
    due = state["wake"] < now
    rows, rest = state[due], state[~due]
    puts, results = rows[rows["what"] == PUT], rows[rows["what"] == RESULT]
    results = results[~np.isin(results["id"], puts["id"])]
    limit = np.where(puts["at"] != NONE, puts["at"] + ttl, NONE)
    out = [(i, "Expired", t) for i, t in zip(puts["id"].tolist(), limit.tolist())]
    ids, of = np.unique(results["id"], return_inverse=True)
    least = np.full(len(ids), NEVER)
    np.minimum.at(least, of, np.where(results["at"] == NONE, NEVER, results["at"]))
    out += [(i, "orphan", t) for i, t in zip(ids.tolist(), np.where(least == NEVER, NONE, least).tolist())]
    puts["what"], puts["wake"] = DONE, np.maximum(now, _ceil_ms(limit)) + keep
    return np.concatenate([rest, puts]), out


class OutcomeProcessor(StatefulProcessor):
    """The records of a bucket: of each, its put and the earliest result that fits wait for each other.

    A result within the time limit decides at once. Without one the record expires when the event clock has passed the limit; a
    put that is already overdue when it is seen waits until the clock moves again, so a result that comes with or before it
    still counts. A result without a put waits for `keep_ms` of event time and is then an orphan. The decision is kept for
    `keep_ms` more, so results that come later change nothing. The bucket has one timer, at the earliest of its records.
    """

    def __init__(self, ttl_ms: int, keep_ms: int):
        self.ttl, self.keep = ttl_ms * 1000, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "rows binary")
        self.timer = handle.getValueState("timer", "ms long")

    def _load(self) -> np.ndarray:
        return np.frombuffer(bytes(self.waiting.get()[0]), STATE) if self.waiting.exists() else np.zeros(0, STATE)

    def _store(self, state: np.ndarray, out: list[tuple]) -> pd.DataFrame:
        if len(state):
            self.waiting.update((state.tobytes(),))
        else:
            self.waiting.clear()
        wanted = int(state["wake"].min()) if len(state) else None
        have = self.timer.get()[0] if self.timer.exists() else None
        if have != wanted:
            if have is not None:
                self.handle.deleteTimer(have)
                self.timer.clear()
            if wanted is not None:
                self.handle.registerTimer(wanted)
                self.timer.update((wanted,))
        return pd.DataFrame(out, columns=_COLUMNS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = []
        for pdf in rows:
            part = np.zeros(len(pdf), STATE)
            part["id"], part["what"], part["at"], part["ok"] = (pdf[c].to_numpy() for c in ("source_id", "what", "at_us", "success"))
            parts.append(part)
        yield self._store(*settle(self._load(), np.concatenate(parts), self.ttl, self.keep, timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        yield self._store(*expire(self._load(), self.ttl, self.keep, timerValues.getCurrentWatermarkInMs()))

    def close(self) -> None:
        pass


def stream_outcomes(puts: DataFrame, results: DataFrame, ttl_ms: int, lateness: str = "1 minute", keep_ms: int = 3_600_000,
                    ticks: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """source_id, outcome (delivered, failed, Expired, orphan), at_us: one row per put, whatever order the rows come in.

    puts: source_id, arrival_ts; results: source_id, success, finished_ts; ticks: ts, which only moves the clock. A record put
    twice counts once, with its first arrival; of several results that fit, the first to finish decides. A put without a time
    expires, and a result without one fits no put.
    """
    kind = lambda what: F.lit(what).alias("what")
    rows = puts.select("source_id", kind(PUT), F.col("arrival_ts").alias("ts"), F.lit(False).alias("success"))
    rows = rows.unionByName(results.select("source_id", kind(RESULT), F.col("finished_ts").alias("ts"), F.coalesce("success", F.lit(False)).alias("success")))
    if ticks is not None:
        rows = rows.unionByName(ticks.select("ts", kind(DONE)), allowMissingColumns=True)
    rows = event_clock(rows.withColumn("at_us", F.unix_micros("ts")), F.col("ts"), lateness, F.col("what") == DONE)
    rows = rows.select(_bucket(buckets), _whole("source_id"), "what", _whole("at_us"), "success")
    out = rows.groupBy("bucket").transformWithStateInPandas(OutcomeProcessor(ttl_ms, keep_ms), OUTCOMES, "Append", "EventTime")
    return _with_nulls(out, "source_id", "at_us")


FINISHED = "source_id long, success boolean, finished_us long"


class FinishProcessor(StatefulProcessor):
    """The first terminal result of each record of a bucket leaves; that it has left is kept for the record's time to live after that:
    the ids that leave in one micro-batch are one entry of the state, which lives as long as they do."""

    def __init__(self, ttl_ms: int):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.left = handle.getMapState("left", "part long", "ids binary", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in FINISHED.split(", ")]
        some = [pdf[["source_id", "success", "finished_us"]] for pdf in rows]
        new = pd.concat(some).assign(failed=lambda x: ~x["success"].astype(bool), timeless=lambda x: x["finished_us"] == NONE)
        new = new.sort_values(["source_id", "timeless", "finished_us", "failed"]).drop_duplicates("source_id")
        parts = {part: np.frombuffer(bytes(ids), np.int64) for (part,), (ids,) in self.left.iterator()}
        if parts:
            new = new[~np.isin(new["source_id"].to_numpy(), np.concatenate(list(parts.values())))]
        if len(new):
            self.left.updateValue((max(parts, default=-1) + 1,), (new["source_id"].to_numpy(np.int64).tobytes(),))
        yield new[names].reset_index(drop=True)

    def close(self) -> None:
        pass


def finish_once(results: DataFrame, ttl_ms: int, buckets: int = BUCKETS) -> DataFrame:
    """Each record's first result to come; of those in one micro-batch the first to finish. Nothing is too late: the state lives
    by the wall clock, for `ttl_ms` from the result that left, and no watermark drops a row. Run it with `idle=False` where a run
    is to end."""
    rows = results.select("source_id", F.coalesce("success", F.lit(False)).alias("success"), F.unix_micros("finished_ts").alias("finished_us"))
    rows = rows.select(_bucket(buckets), _whole("source_id"), "success", _whole("finished_us"))
    out = rows.groupBy("bucket").transformWithStateInPandas(FinishProcessor(ttl_ms), FINISHED, "Append", "ProcessingTime")
    return _with_nulls(out, "source_id", "finished_us")

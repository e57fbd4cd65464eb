"""Numpy helper for one stretch of ordered records: where does a buffer that starts at record s flush next?

All rows of a stretch are known, so a flush is found with a few vector operations instead of a per-row loop.
A buffer is always the contiguous range [s, j) of records added and not yet flushed.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

NEVER = np.iinfo(np.int64).max
# fixed values of the record format: placeholder key, magic + digest bytes, placeholder estimate
PLACEHOLDER = " "
ENVELOPE = 20
PLACEHOLDER_ESTIMATE = 12
PLACEHOLDER_EXACT = 6


@dataclass(frozen=True)
class BatchRule:
    """When a buffer flushes and how much of it leaves.

    packed     -- sizes follow the dictionary-coded packed record; otherwise sizes just add up
    size_limit -- flush once the size estimate plus `margin` reaches it; a batch's exact size plus `margin` stays within it
    """
    size_limit: int = NEVER
    count_limit: int = NEVER
    packed: bool = False
    margin: int = 30
    burst_limit: int = NEVER
    use_deadline: bool = True


def _varlen(x: np.ndarray) -> np.ndarray:
    return 1 + (x >= 1 << 7).astype(np.int64) + (x >= 1 << 14) + (x >= 1 << 21) + (x >= 1 << 28)


def _previous(codes: np.ndarray) -> np.ndarray:
    """Index of the previous row with the same code, -1 if none."""
    prev = np.full(len(codes), -1, np.int64)
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    prev[order[1:][same]] = order[:-1][same]
    return prev


class _Keys:
    """A text column as codes with lengths; null rows have code -1."""

    def __init__(self, values: pd.Series):
        self.codes, names = pd.factorize(values)
        self.codes = self.codes.astype(np.int64)
        texts = [str(n) for n in names]
        chars = np.array([len(t) for t in texts] + [0], np.int64)
        octets = np.array([len(t.encode()) for t in texts] + [0], np.int64)
        self.present = self.codes >= 0
        self.chars, self.octets = chars[self.codes], octets[self.codes]
        real = np.array([t != PLACEHOLDER for t in texts] + [False])
        self.real = real[self.codes]
        self.prev = _previous(self.codes)
        self._index = np.zeros(len(texts) + 1, np.int64)

    def new(self, s: int, e: int) -> np.ndarray:
        return self.real[s:e] & (self.prev[s:e] < s)

    def indexes(self, s: int, e: int, new: np.ndarray) -> np.ndarray:
        """Position of each row's key in the table of a batch starting at s (0 = placeholder or none)."""
        codes = self.codes[s:e]
        self._index[codes[new]] = np.cumsum(new)[new]
        return np.where(self.real[s:e], self._index[codes], 0)


class Stretch:
    def __init__(self, pdf: pd.DataFrame, rule: BatchRule):
        self.rule, self.n = rule, len(pdf)
        self.size = pdf["size"].to_numpy(np.int64)
        self.arrival = pdf["arrival_us"].to_numpy(np.int64)
        self.deadline = pdf["deadline_us"].to_numpy(np.int64)
        self.flag = pdf["flag"].to_numpy(bool)
        if rule.packed:
            self.pk, self.ehk = _Keys(pdf["pk"]), _Keys(pdf["ehk"])
        if rule.burst_limit != NEVER:
            groups = pdf["burst_key"]
            self.burst_codes = pd.factorize(groups)[0].astype(np.int64)
            self.burst_prev = _previous(self.burst_codes)
            self.burst_sum = self_sum = np.zeros(self.n, np.int64)
            known = (self.burst_codes >= 0) & (groups.to_numpy() != -1)
            self_sum[:] = pd.Series(np.where(known, self.size, 0)).groupby(self.burst_codes).cumsum().to_numpy()
            self._burst_base = np.zeros(self.burst_codes.max() + 2, np.int64)
            self.burst_size = np.where(known, self.size, 0)

    def _estimates(self, s: int, e: int) -> np.ndarray:
        """Size estimate of [s, i] for each i in [s, e)."""
        size = self.size[s:e]
        if not self.rule.packed:
            return np.cumsum(size)
        new_pk, new_ehk = self.pk.new(s, e), self.ehk.new(s, e)
        step = size + 5 + np.where(new_pk, self.pk.chars[s:e] + 3, 0)
        step = step + np.where(self.ehk.present[s:e], 2, 0) + np.where(new_ehk, self.ehk.chars[s:e] + 3, 0)
        out = np.cumsum(step) + PLACEHOLDER_ESTIMATE
        out[0] = size[0]
        return out

    def _exact(self, s: int, e: int) -> np.ndarray:
        """Exact size of [s, i] for each i in [s, e)."""
        size = self.size[s:e]
        if not self.rule.packed:
            return np.cumsum(size)
        new_pk, new_ehk = self.pk.new(s, e), self.ehk.new(s, e)
        pk, ehk = self.pk.indexes(s, e, new_pk), self.ehk.indexes(s, e, new_ehk)
        body = np.where(pk > 0, 1 + _varlen(pk), 0) + np.where(ehk > 0, 1 + _varlen(ehk), 0)
        body = body + np.where(size > 0, 1 + _varlen(size) + size, 0)
        step = 1 + _varlen(body) + body
        for keys, new in ((self.pk, new_pk), (self.ehk, new_ehk)):
            octets = keys.octets[s:e]
            step = step + np.where(new, 1 + _varlen(octets) + octets, 0)
        out = np.cumsum(step) + ENVELOPE + PLACEHOLDER_EXACT
        out[0] = size[0]
        return out

    def _burst(self, s: int, e: int) -> np.ndarray:
        """Bytes of row i's shard buffered in [s, i]."""
        codes, total = self.burst_codes[s:e], self.burst_sum[s:e]
        first = self.burst_prev[s:e] < s
        self._burst_base[codes[first]] = total[first] - self.burst_size[s:e][first]
        return total - self._burst_base[codes]

    def prefix(self, s: int, e: int) -> int:
        """End of the longest batch that starts at s, stays within the limits and ends by e; at least one record."""
        e = min(e, s + self.rule.count_limit) if self.rule.count_limit != NEVER else e
        if self.rule.size_limit == NEVER:
            return e
        fits = self._exact(s, e) + self.rule.margin <= self.rule.size_limit
        return s + max(1, len(fits) if fits.all() else int(np.argmin(fits)))

    def _timer(self, s: int, j: int) -> int:
        """A deadline that has passed when a record is added fires at once."""
        return int(max(self.deadline[s], self.arrival[j - 1]))

    def next_flush(self, s: int, j: int, stop: int):
        """First flush of a buffer [s, j) while records j..stop-1 arrive: (batch end, records added, time, reason) or None."""
        r, width = self.rule, 32
        while True:
            e = min(stop, j + width)
            at = np.arange(j, e)
            late = (self.arrival[j:e] > self.deadline[s]) & (at > s) if r.use_deadline else np.zeros(e - j, bool)
            hit = self.flag[j:e] | late
            if r.count_limit != NEVER:
                hit = hit | (at + 1 - s >= r.count_limit)
            if r.size_limit != NEVER:
                full = self._estimates(s, e)[j - s:] + r.margin >= r.size_limit
                hit = hit | full
            if r.burst_limit != NEVER:
                hit = hit | (self._burst(s, e)[j - s:] >= r.burst_limit)
            if hit.any():
                k = int(np.argmax(hit))
                t = j + k
                if late[k]:
                    return self.prefix(s, t), t, self._timer(s, t), "deadline"
                if r.count_limit != NEVER and t + 1 - s >= r.count_limit:
                    reason = "count"
                elif r.size_limit != NEVER and full[k]:
                    reason = "size"
                else:
                    reason = "flag" if self.flag[t] else "burst"
                return self.prefix(s, t + 1), t + 1, int(self.arrival[t]), reason
            if e == stop:
                return None
            width *= 2

    def due(self, s: int, j: int, until: int):
        """Timer flush of [s, j) if its deadline lies before `until`."""
        if s < j and self.rule.use_deadline and self.deadline[s] < until:
            return self.prefix(s, j), j, self._timer(s, j), "deadline"
        return None

    def inheritable(self, own: int) -> list[int]:
        """Buffer starts that can exist when record `own` arrives (the last, `own`, is the empty buffer).

        A buffer without its newest record has not triggered a flush; records above the size limit are left
        out of the sums because they wait for the next arrival.
        """
        r, start = self.rule, np.arange(own)
        ok = np.ones(own, bool)
        if own == 0:
            return [0]
        if r.use_deadline:
            ok &= (self.deadline[:own] >= self.arrival[own - 1]) | (start == own - 1)
        giant = self.size[:own - 1] + r.margin >= r.size_limit if r.size_limit != NEVER else np.zeros(own - 1, bool)
        if r.size_limit != NEVER:
            least = np.where(giant, 0, self.size[:own - 1] + (5 if r.packed else 0))
            total = np.append(np.cumsum(least[::-1])[::-1], 0)
            ok &= total < r.size_limit
        if r.count_limit != NEVER:
            others = np.append(np.cumsum(~giant[::-1])[::-1], 0)
            ok &= others < r.count_limit
        return [*start[ok].tolist(), own]

    def run(self, s: int, j: int, stop: int, until: int, memo: dict | None = None, flushes: list | None = None) -> int:
        """Process records j..stop-1 with buffer [s, j), then timers before `until`; returns the new buffer start."""
        seen = []
        while True:
            if memo is not None:
                if (s, j) in memo:
                    s = memo[(s, j)]
                    break
                seen.append((s, j))
            flush = self.next_flush(s, j, stop) if j < stop else None
            if flush is None:
                j = stop
                flush = self.due(s, j, until)
            if flush is None:
                break
            end, j, when, reason = flush
            if flushes is not None:
                flushes.append((s, end, when, reason))
            s = end
        if memo is not None:
            memo.update(dict.fromkeys(seen, s))
        return s

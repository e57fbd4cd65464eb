"""The streaming packer holds a micro-batch of one key in little memory and searches it piece by piece."""
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from sparkpack.operators.fold import BatchRule
from sparkpack.plans import packing_queries as P
from sparkpack.sources import fixtures as fx
from sparkpack.streaming import processors


class State:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def put(self, value):
        self.value = value

    update = put

    def clear(self):
        self.value = None


class Handle:
    def getListState(self, name, schema):
        return State()

    getValueState = getListState

    def registerTimer(self, ms):
        pass

    deleteTimer = registerTimer


class Times:
    def __init__(self, ms=0):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def chunks(n, seed=3, every=None, size=10_000):
    """Rows of one key as they come from Spark: some thousand at a time, in no order; every n-th is followed by a flush command."""
    rng = np.random.default_rng(seed)
    ids = rng.permutation(n)
    for lo in range(0, n, size):
        i = ids[lo: lo + size]
        at = i * 60_000_000
        rows = pd.DataFrame({
            "kind": "put", "id": i, "size": i % 40, "arrival_us": at, "deadline_us": at + 6 * 3_600_000_000, "flag": False,
            "pk": [f"user-{k % 1500}" for k in i], "ehk": [str(k % 7) if k % 10 == 0 else None for k in i], "burst_key": -1})
        if every:
            marks = rows[rows["id"] % every == every - 1].assign(kind="flush", id=-1, pk=None, ehk=None)
            rows = pd.concat([rows, marks], ignore_index=True)
        yield rows


def pack(rule, rows, key=("view", 1)):
    p = processors.PackProcessor(rule)
    p.init(Handle())
    return p, p.handleInputRows(key, rows, Times())


def frame(rule, rows):
    p, out = pack(rule, rows)
    out = pd.concat(list(out), ignore_index=True)
    return out, p.buffer.value, p.first.value


def per_row(rule, n, every=None):
    data = list(chunks(n, every=every))
    tracemalloc.start()
    try:
        _, out = pack(rule, iter(data))
        left = sum(len(part) for part in out)
        return left, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


RULES = [(P.full_rule(fx.SCALED), None), (BatchRule(use_deadline=False), 50)]


@pytest.mark.parametrize("rule, every", RULES)
def test_pieces_change_nothing(monkeypatch, rule, every):
    whole, buffer, first = frame(rule, chunks(3000, every=every))
    monkeypatch.setattr(processors, "PIECE", 64)
    cut, cut_buffer, cut_first = frame(rule, chunks(3000, every=every))
    pd.testing.assert_frame_equal(whole, cut)
    assert buffer == cut_buffer and first == cut_first and len(whole) + len(buffer or []) == 3000


def test_memory_of_a_large_key():
    """From 100,000 to 200,000 rows, a row takes some hundred bytes, not several copies of itself."""
    rule = P.full_rule(fx.SCALED)
    (a, small), (b, large) = per_row(rule, 100_000), per_row(rule, 200_000)
    assert a > 99_000 and b > 199_000
    assert (large - small) / 100_000 < 150


def test_memory_of_a_large_key_with_flush_commands():
    rule = BatchRule(use_deadline=False)
    (a, small), (b, large) = per_row(rule, 100_000, 200), per_row(rule, 200_000, 200)
    assert (a, b) == (100_000, 200_000)
    assert (large - small) / 100_000 < 150

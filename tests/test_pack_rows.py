"""Rows of a key in the streaming packer: distinct texts stay small, state is read and written in pieces, nothing changes."""
import os
import subprocess
import sys

import numpy as np
import pandas as pd

from sparkpack.operators.fold import BatchRule
from sparkpack.streaming import processors

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class State:
    def __init__(self):
        self.value, self.most = None, 0

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def put(self, value):
        self.value, self.most = value, max(self.most, len(value))

    def appendList(self, value):
        self.value, self.most = self.value + value, max(self.most, len(value))

    def update(self, value):
        self.value = value

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
    def getCurrentWatermarkInMs(self):
        return 0

    def getExpiryTimeInMs(self):
        return 0


def rows(n, size=10_000, every=None):
    """Distinct partition keys, and distinct explicit keys on every tenth row; no order."""
    rng = np.random.default_rng(5)
    for lo in range(0, n, size):
        i = np.arange(lo, min(lo + size, n))
        at = rng.integers(0, 1 << 41, len(i))
        yield pd.DataFrame({
            "kind": ["flush" if every and k % every == every - 1 else "put" for k in i], "id": i, "size": i % 40, "arrival_us": at,
            "deadline_us": at + 1000, "flag": False, "pk": [f"{k * 7919 % 300_000}" for k in i],
            "ehk": [f"{k:040d}" if k % 10 == 0 else None for k in i], "burst_key": -1})


def processor():
    p = processors.PackProcessor(BatchRule(use_deadline=False))
    p.init(Handle())
    return p


GROWTH = """
import re
from pathlib import Path
from tests.test_pack_rows import Times, processor, rows

def peak(n):
    left = sum(len(part) for part in processor().handleInputRows(("view", 1), rows(n, every=200), Times()))
    return left, int(re.search("VmHWM:[^0-9]+([0-9]+)", Path("/proc/self/status").read_text())[1]) * 1024

(a, small), (b, large) = peak(300_000), peak(1_500_000)
assert a > 298_000 and b > 1_492_000
print((large - small) / 1_200_000)
"""


def test_memory_of_a_row_with_distinct_texts():
    """Of the process as a whole, because Arrow's memory and what the allocator keeps count too."""
    out = subprocess.run([sys.executable, "-c", GROWTH], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True, check=True)
    assert float(out.stdout) < 100, out.stdout


def test_state_passes_in_pieces(monkeypatch):
    """Rows without a flush command wait; they leave unchanged when the stream ends."""
    monkeypatch.setattr(processors, "PIECE", 64)
    p = processor()
    assert sum(map(len, p.handleInputRows(("view", 1), rows(1000, size=300), Times()))) == 0
    put = pd.concat(rows(1000, size=300)).sort_values(["deadline_us", "arrival_us", "id"]).assign(late=False)
    kept = pd.DataFrame(p.buffer.value, columns=processors._ROW)
    pd.testing.assert_frame_equal(kept, put[processors._ROW].reset_index(drop=True))
    assert p.buffer.most <= 64
    out = pd.concat(p.handleExpiredTimer(("view", 1), Times(), Times()))
    assert out["id"].tolist() == put["id"].tolist() and (out["flush_us"] == processors.END_US).all()


def test_rows_come_back_as_they_were(monkeypatch):
    """Numbers of any width, negative ones, repeated, empty and missing texts, chunks without rows."""
    monkeypatch.setattr(processors, "PIECE", 4)
    wide = [0, -1, 127, 128, -129, 40_000, -(1 << 31), 1 << 31, (1 << 63) - 1, -(1 << 63)]
    texts = ["a", None, "", "a", "ü€", "b" * 300, None, "a", "b" * 300, " "]
    every = pd.DataFrame({
        "id": wide, "size": wide[::-1], "arrival_us": wide, "deadline_us": wide, "flag": [True, False] * 5, "pk": texts,
        "ehk": [None] * 9 + ["c"], "burst_key": [-1] * 8 + [300, -1], "late": False})
    cols = processors._Columns()
    for lo, hi in ((0, 0), (0, 3), (3, 3), (3, 4), (4, 10)):
        cols.add(every[lo:hi])
    cols.close()
    back = cols.frame(0, 10)
    assert back.astype(object).where(back.notna(), None).values.tolist() == every[processors._ROW].astype(object).values.tolist()
    assert cols.frame(2, 2).empty and len(cols) == 10

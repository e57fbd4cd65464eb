"""Task-side terms: runs of chosen bytes, lower-cased, counted exactly per document; their CRC-32."""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from sparkpack.llm.common import BYTE_VALUES, GOLDEN, LOWER, byte_table, mix, powers, runs, text_chunks

#: Letters of ASCII and every byte of other characters; the same with digits.
TERM = byte_table(lambda b: b >= 128 or 65 <= b <= 90 or 97 <= b <= 122)
WORD = byte_table(lambda b: b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)

#: Bytes of text handled at a time: the arrays of a slice take about 50 times that.
SLICE = 2 << 20


def slices(data: np.ndarray, inside: np.ndarray, limit: int = SLICE) -> Iterator[np.ndarray]:
    """A text in slices of about `limit` bytes, cut only between runs."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + limit)
        while hi < n and inside[data[hi - 1]]:
            outside = np.flatnonzero(~inside[data[hi: hi + limit]])
            hi = hi + int(outside[0]) + 1 if len(outside) else min(n, hi + limit)
        yield data[lo:hi]
        lo = hi


def text_slices(column: pa.Array, inside: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """First row, bytes, offsets, and whether the text goes on in the next slice. Long texts come in several slices."""
    for lo, _, data, offsets in text_chunks(column, limit):
        if len(data) <= limit or len(offsets) > 2:
            yield lo, data, offsets, False
            continue
        parts, last = slices(data, inside, limit), None
        for part in parts:
            if last is not None:
                yield lo, last, np.array([0, len(last)]), True
            last = part
        yield lo, last, np.array([0, len(last)]), False


def distinct_runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Document and term number of each run, and the distinct lower-cased terms.

    Runs are grouped by hash and compared byte by byte with their group's first run; should two terms ever share a
    hash, the slice is numbered by its strings.
    """
    starts, ends, doc = runs(data, offsets, inside)
    if not len(starts):
        return doc, doc, pa.array([], pa.string())
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    chars = LOWER[data[within + np.repeat(starts, lengths)]]
    hashes = mix(np.add.reduceat(BYTE_VALUES[chars] * powers(int(lengths.max()))[within], first) + lengths.astype(np.uint64) * GOLDEN)
    _, example, term = np.unique(hashes, return_index=True, return_inverse=True)
    same = lengths[example][term]
    if not (np.array_equal(same, lengths) and np.array_equal(chars, chars[np.repeat(first[example][term], lengths) + within])):
        whole = [chars[a: a + n].tobytes() for a, n in zip(first.tolist(), lengths.tolist())]
        number: dict[bytes, int] = {}
        term = np.array([number.setdefault(w, len(number)) for w in whole])
        return doc, term, pa.array([w.decode("utf-8", "replace") for w in number], pa.string())
    size = lengths[example]
    at = np.concatenate([[0], np.cumsum(size)])
    spread = np.arange(int(at[-1])) - np.repeat(at[:-1], size) + np.repeat(first[example], size)
    terms = pa.StringArray.from_buffers(len(size), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(chars[spread]))
    return doc, term, terms


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often (or with what weight) each occurs."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.concatenate([first, [len(keys)]])) if weights is None else np.add.reduceat(weights[order], first) if len(keys) else first
    return keys[first], n


_CRC = np.zeros(256, np.uint32)
for _b in range(256):
    _c = _b
    for _ in range(8):
        _c = _c >> 1 ^ (0xEDB88320 if _c & 1 else 0)
    _CRC[_b] = _c


def run_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int = 64) -> np.ndarray:
    """CRC-32 of the lower-cased bytes of each run: all runs a byte at a time, those past `longest` bytes on their own."""
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, longest + 1), kind="stable")
    at, left = starts[order], lengths[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    long = int((left > longest).sum())
    for j in range(int(left[long]) if long < len(left) else 0):
        n = int(np.searchsorted(-left[long:], -j, "left"))
        c = crc[long: long + n]
        crc[long: long + n] = _CRC[(c ^ LOWER[data[at[long: long + n] + j]]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    for i in order[:long].tolist():
        out[i] = zlib.crc32(LOWER[data[starts[i]: ends[i]]].tobytes())
    return out

"""Helpers of the training-data operators: words, stage tables, ranks without a hot group, components, task-side arrays."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.operators.stage import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null document id where ids are compared; smaller than every real id.
NO_ID = -(2**63)


def stage(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, survives lost executors."""
    return materialize(df)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def id_key(col: str) -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NO_ID))


def seeded_hash(seed: int, *cols: Column) -> Column:
    """The first 60 bits of an MD5 of seed and columns: an order any SQL engine can repeat."""
    parts = [F.coalesce(c.cast("string"), F.lit("-")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 15), 16, 10).cast("long")


def running(df: DataFrame, keys: list[str], slot: Column, order: list[Column], value: Column, slots: int,
            name: str) -> DataFrame:
    """Add `name`: the sum of value over the rows of the same keys before this one, without a task per key.

    slot (0 .. slots-1, never null) must not go back along the order. Rows are summed per (keys, slot), the sums are scanned
    per key (at most `slots` small rows), and each (keys, slot) is scanned on its own; equally filled slots keep
    every task small whatever share of the rows one key holds. keys may be empty.
    """
    rows = stage(df.withColumn("_slot", slot.cast("long")).withColumn("_value", value.cast("long")))
    sums = rows.groupBy(*keys, "_slot").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0).cast("long")))
    starts = stage(starts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slot").alias("_s"), "_start"))
    on = F.col("_slot") == F.col("_s")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*keys, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("_in", F.coalesce(F.sum("_value").over(inside), F.lit(0).cast("long"))).join(starts, on)
    return out.withColumn(name, F.col("_start") + F.col("_in")).drop("_slot", "_value", "_s", "_start", "_in",
                                                                     *[f"_k{i}" for i in range(len(keys))])


def slots_for(rows: int, per_slot: int = 2000, least: int = 1024) -> int:
    """Slots for `running`: they grow with the rows, so the rows of one slot do not."""
    return max(least, -(-rows // per_slot))


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to (node, label): label is the smallest node reachable.

    Each round every node takes its smallest neighbour, then that one's; the edges are contracted to the labels and the
    ones inside a label drop out, so rounds shrink. Rounds are stage tables, and joins have one unique side whose own
    exchange lets Spark split a hub's rows.
    """
    edges = stage(edges.select("a", "b").filter("a <> b").distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = stage(nodes.select("node", F.col("node").alias("label")))
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m")).select("x", F.least("x", "m").alias("up")))
        higher = least.select(F.col("x").alias("y"), F.col("up").alias("top"))
        least = stage(least.join(higher, least["up"] == higher["y"]).select("x", "top"))
        labels = stage(labels.join(least, labels["label"] == least["x"], "left").select("node", F.coalesce("top", "label").alias("label")))
        left = edges.join(least, edges["a"] == least["x"]).select(F.col("top").alias("a"), "b")
        both_ends = left.join(least, left["b"] == least["x"]).select("a", F.col("top").alias("b")).filter("a <> b")
        edges = stage(both_ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels


# Task-side arrays -------------------------------------------------------------------------------------------------

_M1, _M2, GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def golden(j: int) -> np.uint64:
    """The j-th step of a Weyl sequence."""
    return np.uint64(j * int(GOLDEN) & (2**64 - 1))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * GOLDEN)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        base = np.full(max(n, 2 * len(_powers)), np.uint64(0xD6E8FEB86659FD93))
        base[0] = 1
        _powers = np.multiply.accumulate(base)
    return _powers


def byte_table(inside) -> np.ndarray:
    return np.array([bool(inside(b)) for b in range(256)])


NOT_BLANK = byte_table(lambda b: not (b == 32 or 9 <= b <= 13))
LETTERS = byte_table(lambda b: b >= 128 or 65 <= b <= 90 or 97 <= b <= 122)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def text_chunks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a text column of about `limit` bytes: first row, end row, bytes, offsets (one more than rows).

    Nulls are empty. A longer text is a slice of its own.
    """
    col = column.cast(pa.large_binary())
    col = col.fill_null(b"") if col.null_count else col
    n = len(col)
    if not n:
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        lo = hi


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document of the maximal runs of bytes inside the table; no run crosses a document."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    mask = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    after = np.empty_like(mask)
    after[-1], after[:-1] = False, mask[1:]
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs, A-Z lower-cased."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = BYTE_VALUES[LOWER[data[within + np.repeat(starts, lengths)]]] * powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * GOLDEN)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table per run of equal (long) keys; the batches come sorted by them."""
    parts: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        head = tuple(c[0] for c in cols)
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for at, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            if parts and (at or head != last):
                yield pa.Table.from_batches(parts)
                parts = []
            parts.append(batch.slice(lo, hi - lo))
        last = tuple(c[-1] for c in cols)
    if parts:
        yield pa.Table.from_batches(parts)


def lists_to_arrays(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column without nulls."""
    col = column.combine_chunks()
    col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    lengths = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return col.flatten().to_numpy(zero_copy_only=False).astype(dtype), np.concatenate([[0], np.cumsum(lengths)])


class Sets:
    """Union-find over small integers of one task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def stars(sets: Sets, names: list) -> tuple[list, list]:
    """Per local component an edge from each other member to the smallest name: the same edges wherever its members meet."""
    least: dict[int, object] = {}
    roots = [sets.find(x) for x in range(len(names))]
    for r, name in zip(roots, names):
        if r not in least or name < least[r]:
            least[r] = name
    pairs = [(least[r], name) for r, name in zip(roots, names) if name != least[r]]
    return [a for a, _ in pairs], [b for _, b in pairs]

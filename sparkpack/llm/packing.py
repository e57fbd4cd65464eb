"""Best-fit packing by a grouping genetic algorithm on islands."""
from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from random import Random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.llm.common import GOLDEN, mix, powers, sorted_groups, stage

CAPACITY, END_ID = 4096, 1
#: Pieces of one block on average: the problem one population solves.
BLOCK = 400
ISLANDS, POPULATION, GENERATIONS, ROUNDS = 2, 4, 6, 2
#: Bins filled less than this share in the first pass are opened again and packed together in a second.
GOOD_FILL = 0.97
_SEED = 4096

# Tokens ----------------------------------------------------------------------------------------------------------

#: Anything but the characters for which texts are cut here: printable ASCII, usual blanks, Latin letters, common marks.
_ODD = re.compile(r"[^\t\n\r\x20-\x7e¡-±´-¸º»¿À-ÖØ-öø-įĲ-ňŊ-ž–-…€]")
_BLANK = re.compile(r"\s")
#: Cuts kept per generation of the table.
_KEPT = 400_000
#: Characters cut at a time; the arrays take about 60 bytes for each.
CHARS = 1 << 20

_kinds: np.ndarray | None = None


def kinds() -> np.ndarray:
    """Code to the kind of cut it belongs to: 0 blank, 1 letter, 2 digit, 3 anything else."""
    global _kinds
    if _kinds is None:
        _kinds = np.full(1 << 16, 3, np.uint8)
        for code in range(1 << 16):
            c = chr(code)
            _kinds[code] = 0 if c.isspace() else 2 if "0" <= c <= "9" else 1 if c.isalpha() else 3
    return _kinds


def cuts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the cuts of a lower-cased text that ends with a blank: as the tokenizer cuts it.

    Letters and other marks form runs, each digit stands alone, and a single apostrophe takes the ending of a short form
    from the run of letters behind it.
    """
    kind = kinds()[codes]
    edge = np.empty(len(kind), bool)
    edge[:1] = True
    edge[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(codes))
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    mark = np.flatnonzero((codes[starts] == 39) & (ends - starts == 1) & (kind[np.minimum(ends, len(kind) - 1)] == 1))
    if len(mark):
        at = ends[mark]
        one, two = codes[at], codes[np.minimum(at + 1, len(codes) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((two == ord("e")) & np.isin(one, [ord("r"), ord("v")])) | ((one == ord("l")) & (two == ord("l")))
        taken = np.where(short, 1, np.where(long, 2, 0))
        ends[mark] += taken
        starts[mark + 1] += taken
        left = starts < ends
        starts, ends = starts[left], ends[left]
    return starts, ends


def distinct(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each run among the distinct runs, and an example of each. Runs of one hash are compared code by code."""
    length = ends - starts
    first = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(first, length)
    own = codes[within + np.repeat(starts, length)]
    values = (own.astype(np.uint64) + np.uint64(1)) * GOLDEN * powers(int(length.max()))[within]
    hashes = mix(np.add.reduceat(values, first) + length.astype(np.uint64) * GOLDEN)
    _, example, number = np.unique(hashes, return_index=True, return_inverse=True)
    same = np.array_equal(length[example][number], length)
    if not (same and np.array_equal(own, own[np.repeat(first[example][number], length) + within])):
        seen: dict[bytes, int] = {}
        runs_of = [own[a: a + n].tobytes() for a, n in zip(first.tolist(), length.tolist())]
        number = np.array([seen.setdefault(r, len(seen)) for r in runs_of])
        _, example = np.unique(number, return_index=True)
    return number, example


class Recent:
    """A bounded table: two generations, the older one dropped when the newer is full."""

    def __init__(self, make, most: int = _KEPT):
        self.make, self.most = make, most
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, words: Iterable[str]) -> dict[str, bytes]:
        """A table that holds all of the words."""
        missing = set(words).difference(self.new)
        if len(self.new) + len(missing) > self.most and self.new:
            self.old, self.new = self.new, {}
            missing = set(words)
        old = self.old
        self.new.update((w, old[w]) for w in missing if w in old)
        make = [w for w in missing if w not in old]
        if make:
            self.new.update(zip(make, self.make(make)))
        return self.new


class WordTokens:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer encodes each of its cuts on its own, so a plain text is the concatenation of its cuts' ids, which a
    bounded table keeps. Any text with other characters or a special token's brackets goes to the
    tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = Recent(self._merge)
        # the byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for characters from 256 on
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {b: 256 + i for i, b in enumerate(rest)}

    def _encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for lo in range(0, len(texts), 1000):
            out += [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts[lo: lo + 1000], add_special_tokens=False)]
        return out

    def _merge(self, cuts: list[str]) -> list[bytes]:
        """The merges of single cuts, without the tokenizer's steps before them."""
        merge, alphabet = self.tokenizer.model.tokenize, self.alphabet
        out = []
        for c in cuts:
            at = c if c.isascii() else c.encode("utf-8").decode("latin-1").translate(alphabet)
            out.append(struct.pack(f"<{len(ids)}I", *ids) if (ids := [t.id for t in merge(at)]) else b"")
        return out

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Texts of the characters above: numpy cuts them and numbers their distinct cuts, of which alone Python makes strings."""
        text = "\n".join([*texts, ""])
        codes = np.frombuffer(text.encode("utf-16-le"), "<u2")
        starts, ends = cuts(codes)
        if not len(starts):
            return [b""] * len(texts)
        number, examples = distinct(codes, starts, ends)
        words = [text[a:e] for a, e in zip(starts[examples].tolist(), ends[examples].tolist())]
        table = self.cuts.of(words)
        ids = [table[w] for w in words]
        flat = np.frombuffer(b"".join(ids), "<u4")
        length = np.fromiter((len(i) // 4 for i in ids), np.int64, len(ids))
        first = np.cumsum(length) - length
        own = length[number]                                        # ids of each cut of the text
        done = np.cumsum(own)
        out = flat[np.arange(int(done[-1])) + np.repeat(first[number] - (done - own), own)]
        edge = np.cumsum([len(t) + 1 for t in texts])
        upto = np.concatenate([[0], done])[np.searchsorted(starts, edge)].tolist()
        return [out[a:e].tobytes() for a, e in zip([0, *upto], upto)]

    def _long(self, text: str) -> bytes:
        """A long text in parts of about CHARS characters, cut before blanks, which belong to no cut."""
        parts, lo = [], 0
        while lo < len(text):
            blank = _BLANK.search(text, lo + CHARS)
            hi = blank.start() if blank else len(text)
            parts.append(self._plain([text[lo:hi]])[0])
            lo = hi
        return b"".join(parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain: list[int] = []
        lowered: list[str] = []
        size = 0

        def flush():
            nonlocal size
            for i, ids in zip(plain, self._plain(lowered)):
                out[i] = ids
            plain.clear(), lowered.clear()
            size = 0

        for i, t in enumerate(texts):
            if "<|" in t or _ODD.search(t):
                out[i] = self._encode([t])[0]
            elif len(t) > CHARS:
                out[i] = self._long(t.lower())
            elif t:
                plain.append(i)
                lowered.append(t.lower())
                size += len(t)
                if size > CHARS:
                    flush()
        if plain:
            flush()
        return out


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One per Python worker: tasks share its tables."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]


def text_parts(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about `limit` bytes of text; a longer text is a slice of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _pieces(path: str, capacity: int, end_id: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        for batch in batches:
            for part in text_parts(batch, 1, 4 * CHARS):
                rows: list[tuple] = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), tokens.encode(texts)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids) // 4, capacity)):
                        own = ids[4 * at: 4 * (at + capacity)]
                        rows.append((doc, k, at, len(own) // 4, zlib.crc32(own)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


def token_pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document's ids plus the end id: doc_id, piece, start, length, ids_crc32. tokenizer: a path all executors have.

    Null and empty texts are the end id alone; repeated rows and null ids give their pieces each; other columns are ignored.
    """
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _pieces(tokenizer, capacity, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long")


# Grouping genetic algorithm ----------------------------------------------------------------------------------------

def best_fit(items: Iterable[int], sizes: list[int], bins: list[list[int]], loads: list[int], capacity: int) -> None:
    """Put each item into the fullest bin that still takes it, or a new one."""
    free = sorted((capacity - load, b) for b, load in enumerate(loads) if load < capacity)
    for x in items:
        at = bisect_left(free, (sizes[x], -1))
        if at < len(free):
            space, b = free.pop(at)
            bins[b].append(x)
            loads[b] += sizes[x]
        else:
            space, b = capacity, len(bins)
            bins.append([x])
            loads.append(sizes[x])
        if space > sizes[x]:
            insort(free, (space - sizes[x], b))


def fitness(loads: list[int], capacity: int) -> float:
    """Mean squared fill: rewards few, full bins."""
    return sum((load / capacity) ** 2 for load in loads) / max(1, len(loads))


class Packing:
    def __init__(self, bins: list[list[int]], sizes: list[int], capacity: int):
        self.bins, self.loads = bins, [sum(sizes[x] for x in b) for b in bins]
        self.fit = fitness(self.loads, capacity)


def offspring(mother: Packing, father: Packing, sizes: list[int], capacity: int, rng: Random) -> Packing:
    """Crossover: the father's well-filled bins are injected whole, the mother's bins they touch are dissolved, and the documents displaced are best-fitted, largest first."""
    ranked = sorted(range(len(father.bins)), key=lambda b: -father.loads[b])
    chosen = [b for b in ranked[: max(1, len(ranked) // 2)] if rng.random() < 0.5] or ranked[:1]
    taken = {x for b in chosen for x in father.bins[b]}
    bins, displaced = [list(father.bins[b]) for b in chosen], []
    for b in mother.bins:
        if taken.isdisjoint(b):
            bins.append(list(b))
        else:
            displaced += [x for x in b if x not in taken]
    return _refilled(bins, displaced, sizes, capacity)


def mutant(one: Packing, sizes: list[int], capacity: int, rng: Random) -> Packing:
    """Dissolve the emptiest bin and some others, and best-fit their documents again."""
    worst = min(range(len(one.bins)), key=lambda b: one.loads[b])
    gone = {worst} | {rng.randrange(len(one.bins)) for _ in range(max(1, len(one.bins) // 10))}
    return _refilled([list(b) for i, b in enumerate(one.bins) if i not in gone], [x for i in gone for x in one.bins[i]], sizes, capacity)


def _refilled(bins: list[list[int]], displaced: list[int], sizes: list[int], capacity: int) -> Packing:
    loads = [sum(sizes[x] for x in b) for b in bins]
    best_fit(sorted(displaced, key=lambda x: (-sizes[x], x)), sizes, bins, loads, capacity)
    return Packing(bins, sizes, capacity)


def evolve(sizes: list[int], capacity: int, seed: int, guests: list[list[list[int]]], population: int, generations: int) -> Packing:
    """One island: best-fit packings of several orders and the guests, then steady-state crossover and mutation."""
    rng = Random(seed)
    order = sorted(range(len(sizes)), key=lambda x: (-sizes[x], x))
    pool = [Packing(g, sizes, capacity) for g in guests]
    while len(pool) < population:
        bins: list[list[int]] = []
        best_fit(order, sizes, bins, [], capacity)
        pool.append(Packing(bins, sizes, capacity))
        order = sorted(order, key=lambda x: -sizes[x] * (1 + 0.3 * rng.random()))
    for _ in range(generations):
        mother, father = rng.sample(pool, 2) if len(pool) > 1 else (pool[0], pool[0])
        for child in (offspring(mother, father, sizes, capacity, rng), mutant(max(pool, key=lambda p: p.fit), sizes, capacity, rng)):
            pool.sort(key=lambda p: p.fit)
            if child.fit > pool[0].fit:
                pool[0] = child
    return max(pool, key=lambda p: p.fit)


def _labels(packing: Packing, n: int) -> list[int]:
    out = [0] * n
    for b, items in enumerate(packing.bins):
        for x in items:
            out[x] = b
    return out


def _bins(labels: list[int]) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for x, b in enumerate(labels):
        out.setdefault(b, []).append(x)
    return list(out.values())


_ORDER = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]


def _island(capacity: int, round_: int):
    """Evolve every (block, island); items come with the guests' labels; each item leaves with the elite's label and fitness."""
    def run(batches):
        for group in sorted_groups(batches, ["block", "island"]):
            group = group.sort_by(_ORDER)
            sizes = group.column("length").to_pylist()
            guests = [] if round_ == 0 else [_bins(group.column("bin").to_pylist()), _bins(group.column("guest").to_pylist())]
            seed = ((_SEED * 31 + round_) << 40) + group.column("block")[0].as_py() * ISLANDS + group.column("island")[0].as_py()
            best = evolve(sizes, capacity, seed, guests, POPULATION, GENERATIONS)
            keep = group.select(["doc_id", "piece", "start", "length", "ids_crc32", "block", "no", "island"])
            keep = keep.append_column("bin", pa.array(_labels(best, len(sizes)), pa.int64()))
            keep = keep.append_column("fit", pa.array([best.fit] * len(sizes), pa.float64()))
            yield from keep.combine_chunks().to_batches()
    return run


_FIELDS = "doc_id long, piece int, start long, length long, ids_crc32 long, block long, no long"


def _pass(items: DataFrame, blocks: int, capacity: int, number: int) -> DataFrame:
    """Deal the items to blocks, evolve each block on ISLANDS islands with elites moving on after each round, and add bin (unique in the block)."""
    # equal rows get places of their own: no
    dealt = items.withColumn("block", F.pmod(F.xxhash64(F.lit(number), "doc_id", "piece", "ids_crc32", "no"), F.lit(blocks)))
    world = dealt.withColumn("island", F.explode(F.array(*[F.lit(i).cast("long") for i in range(ISLANDS)])))
    for r in range(ROUNDS):
        if r:
            # the elite of an island visits the next one: an item's label there is a column here
            elite = world.select(F.col("no").alias("_no"), F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("_to"), F.col("bin").alias("guest"))
            world = world.drop("fit").join(elite, (F.col("no") == F.col("_no")) & (F.col("island") == F.col("_to"))).drop("_no", "_to")
        world = world.repartition("block", "island").sortWithinPartitions("block", "island")
        world = stage(world.mapInArrow(_island(capacity, r), f"{_FIELDS}, island long, bin long, fit double"))
    best = world.groupBy("block").agg(F.max(F.struct("fit", (-F.col("island")).alias("minus"))).alias("_b"))
    best = stage(best.select(F.col("block").alias("_block"), (-F.col("_b")["minus"]).alias("_island")))
    return world.join(best, (F.col("block") == F.col("_block")) & (F.col("island") == F.col("_island"))).drop("_block", "_island", "island", "fit")


def pack(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """Add sequence_id and offset: every piece lies whole in one sequence of at most `capacity` tokens.

    Pieces are dealt by hash to blocks of about `block` pieces, so no block grows with the data and none is hot; each
    block is evolved on several islands. Bins below GOOD_FILL are opened and their pieces dealt and evolved once more,
    which leaves a bin or two per second-pass block with room. Full-length pieces are sequences by themselves.
    Repeated rows are separate pieces; an empty table gives an empty one. Reruns agree.
    """
    rows = stage(pieces.withColumn("no", F.monotonically_increasing_id()))
    alone = rows.filter(F.col("length") >= capacity).withColumns({"_pass": F.lit(0), "block": F.lit(0).cast("long"), "bin": F.col("no")})
    small = rows.filter(F.col("length") < capacity)
    first = stage(_pass(small, max(1, small.count() // block), capacity, 1))
    fill = first.groupBy("block", "bin").agg(F.sum("length").alias("_fill"))
    first = stage(first.join(fill, ["block", "bin"]))
    good = F.col("_fill") >= GOOD_FILL * capacity
    loose = first.filter(~good).select("doc_id", "piece", "start", "length", "ids_crc32", "no")
    second = _pass(loose, max(1, loose.count() // (2 * block)), capacity, 2)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "no", "_pass", "block", "bin"]
    parts = [alone, first.filter(good).withColumn("_pass", F.lit(1)), second.withColumn("_pass", F.lit(2))]
    out = parts[0].select(columns).union(parts[1].select(columns)).union(parts[2].select(columns))
    out = out.withColumn("sequence_id", F.when(F.col("_pass") == 0, F.col("no")).otherwise(-(
        F.col("block") * (2 << 20) + F.col("bin") * 2 + F.col("_pass"))))
    before = Window.partitionBy("sequence_id").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))
    return out.drop("no", "_pass", "block", "bin")

"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full sets, union-find grouping."""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.llm.common import (GOLDEN, NOT_BLANK, Sets, components, golden, id_key, lists_to_arrays, mix, run_hashes,
                                  runs, sorted_groups, stage, stars, text_chunks)

#: 24 bands of 4 ranks: a pair at similarity 0.85 shares no band with probability 2e-8, at 0.8 with 3e-6.
BANDS, ROWS = 24, 4
#: A pair in one bucket goes to verification if its signatures agree as often as its similarity less this many deviations.
SLACK = 5.5
BLOCK = 256


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles (64-bit hashes, sorted per document) and their count per document.

    Fewer than k words: the whole sequence is the one shingle; no words: none.
    """
    starts, ends, doc = runs(data, offsets, NOT_BLANK)
    words = run_hashes(data, starts, ends)
    n_docs = len(offsets) - 1
    counts = np.bincount(doc, minlength=n_docs)
    h, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(words) >= k:
        whole = doc[k - 1:] == doc[: len(doc) - k + 1]
        h = np.zeros(len(whole), np.uint64)
        for j in range(k):
            h = mix((h ^ words[j: len(words) - k + 1 + j]) + golden(j + 1))
        h, owner = h[whole], doc[: len(whole)][whole]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])
        one = np.zeros(len(short), np.uint64)
        for i, d in enumerate(short.tolist()):
            x = np.zeros(1, np.uint64)
            for j, w in enumerate(words[first[d]: first[d + 1]]):
                x = mix((x ^ w) + golden(j + 1))
            one[i] = mix(x + np.uint64(counts[d]))[0]
        at = np.searchsorted(owner, short)
        h, owner = np.insert(h, at, one), np.insert(owner, at, short)
    bounds = np.searchsorted(owner, np.arange(n_docs + 1))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        h[lo:hi].sort()
    if len(h):
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[fresh], owner[fresh]
    return h, np.bincount(owner, minlength=n_docs)


def super_minhash(h: np.ndarray, counts: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash signatures (documents x m) of the sets that lie in h one after another.

    Each element has a random permutation of the m slots; its place in it plus a random fraction is its rank there, and a
    slot keeps the smallest. All elements place their j-th slot together; a document stops as soon as every slot
    is below j + 1, since later places can't win any more. Equal slots estimate the Jaccard similarity, with less
    variance than independent hashes because one element's ranks exclude each other.
    """
    n = len(counts)
    sig = np.full(n * m, np.iinfo(np.uint64).max, np.uint64)
    owner, perm = np.repeat(np.arange(n), counts), None
    for j in range(m):
        if not len(h):
            break
        draw = mix(h + golden(j + 1))
        pick = j + (((draw & np.uint64(0xFFFF)) * np.uint64(m - j)) >> np.uint64(16)).astype(np.int64)
        at = np.arange(len(h))
        if perm is None:
            slot = pick
        else:
            slot = perm[at, pick].astype(np.int64)
            perm[at, pick] = perm[:, j]
        np.minimum.at(sig, owner * m + slot, (np.uint64(j) << np.uint64(48)) | (draw >> np.uint64(16)))
        open_ = sig.reshape(n, m).max(axis=1) >= (np.uint64(j + 1) << np.uint64(48))
        live = open_[owner]
        if perm is None:
            h, owner, pick = h[live], owner[live], pick[live]
            perm = np.tile(np.arange(m, dtype=np.uint16), (len(h), 1))
            perm[np.arange(len(h)), pick] = 0
        elif not live.all():
            h, owner, perm = h[live], owner[live], perm[live]
    return sig.reshape(n, m)


def _signatures(k: int, bands: int, rows: int):
    schema = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("fp", pa.binary()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])
    m = bands * rows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi, data, offsets in text_chunks(texts):
                h, counts = shingle_sets(data, offsets, k)
                sig = super_minhash(h, counts, m)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                two = [np.concatenate([[np.uint64(0)], np.cumsum(mix(h * GOLDEN + np.uint64(c)))])[bounds] for c in (1, 2)]
                fp = np.stack([np.diff(t) for t in two], 1).tobytes()
                key = np.zeros((hi - lo, bands), np.uint64)
                for r in range(rows):
                    key = mix(key + sig.reshape(-1, bands, rows)[:, :, r] + golden(r + 1))
                key = mix(key + np.arange(bands, dtype=np.uint64)[None, :]).view(np.int64)
                short = (mix(sig) & np.uint64(0xFF)).astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(counts.astype(np.int64)),
                    pa.array([fp[16 * i: 16 * i + 16] for i in range(hi - lo)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * bands), pa.array(key.ravel())),
                    pa.array([short[m * i: m * i + m] for i in range(hi - lo)], pa.binary()),
                ], schema=schema)
    return run


def _coded(labels: list) -> tuple[list[int], list]:
    """Labels as small integers, and the label of each."""
    known: dict = {}
    return [known.setdefault(x, len(known)) for x in labels], list(known)


def _agreeing(m: int, least: float):
    """Within a bucket (or two blocks of a hot one), the components of the pairs whose signatures agree enough, as edges between labels."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches):
        for group in sorted_groups(batches, ["bucket", "i", "j"]):
            of, labels = _coded(group.column("label").to_pylist())
            sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(of), m)
            sets = Sets(len(labels))
            for x in range(len(of) - 1):
                for y in (np.flatnonzero((sig[x + 1:] == sig[x]).sum(axis=1) >= least * m) + x + 1).tolist():
                    sets.join(of[x], of[y])
            a, b = stars(sets, labels)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=schema)
    return run


def linked_pairs(h: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs with 100 * intersection >= percent * union, exactly: products of 0/1 matrices over the shared shingles."""
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes)
    values, inverse, seen = np.unique(h, return_inverse=True, return_counts=True)
    shared = seen[inverse] > 1
    dense = np.cumsum(seen > 1) - 1
    col, row = dense[inverse[shared]], owner[shared]
    width = int((seen > 1).sum())
    common = np.zeros((n, n), np.float32)
    step = max(1, (1 << 22) // max(1, n))
    by = np.argsort(col, kind="stable")
    col, row = col[by], row[by]
    for lo in range(0, width, step):
        s, e = np.searchsorted(col, [lo, lo + step])
        part = np.zeros((n, min(step, width - lo)), np.float32)
        part[row[s:e], col[s:e] - lo] = 1
        common += part @ part.T
    both = np.rint(common).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    hit = np.triu((100 * both >= percent * union) & (both > 0), 1)
    return np.nonzero(hit)


def _verified(percent: int):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches):
        for group in sorted_groups(batches, ["cluster", "i", "j"]):
            of, labels = _coded(group.column("label").to_pylist())
            h, bounds = lists_to_arrays(group.column("sets"), np.uint64)
            sets = Sets(len(labels))
            for x, y in zip(*(side.tolist() for side in linked_pairs(h, bounds, percent))):
                sets.join(of[x], of[y])
            a, b = stars(sets, labels)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=schema)
    return run


def _linked(rows: DataFrame, group: str, value: str, test, size: int = BLOCK) -> DataFrame:
    """Components (node, label) of the links that `test` finds between rows (group, fp, value) of one group.

    A group's rows lie in blocks of about `size`. First the rows of one block meet those of every block, and each block its own,
    which unites what is much alike and passes on at most two edges a row. Then only rows whose labels still differ have
    to meet: a label with `size` rows or more has blocks of its own, which skip each other, and edges run between labels.
    So every pair with different labels is tested, while a group of copies costs in proportion to its rows.
    """
    counts = stage(rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    place = F.xxhash64("fp")
    sized = rows.join(counts, group).withColumn("_blocks", F.ceil(F.col("_n") / F.lit(size)).cast("int"))
    sized = sized.withColumn("_own", F.pmod(place, F.col("_blocks")).cast("int"))
    meets = F.when(F.col("_own") == 0, F.sequence(F.lit(0), F.col("_blocks") - 1)).otherwise(F.array("_own"))
    first = sized.select(group, "fp", value, F.col("fp").alias("label"), F.lit(0).alias("i"), F.explode(meets).alias("j"))
    labels = components(_edges(first, group, test))
    if counts.filter(F.col("_n") > size).isEmpty():
        return labels
    named = sized.filter(F.col("_n") > size).select(group, "fp").join(labels, F.col("fp") == F.col("node"), "left")
    named = stage(named.select(group, "fp", F.coalesce("label", "fp").alias("label")))
    per = named.groupBy(group, "label").agg(F.count(F.lit(1)).alias("_c"))
    own = F.when(F.col("_c") >= size, F.ceil(F.col("_c") / F.lit(size)).cast("int"))
    per = stage(per.withColumn("_wide", own))
    mixed = F.ceil(F.coalesce(F.sum(F.when(F.col("_wide").isNull(), F.col("_c"))), F.lit(0)) / F.lit(size)).cast("int")
    groups = per.groupBy(group).agg(F.count(F.lit(1)).alias("_labels"), mixed.alias("_mixed"), F.coalesce(F.sum("_wide"), F.lit(0)).cast("int").alias("_alone"))
    groups = stage(groups.filter("_labels > 1").select(group, "_mixed", (F.col("_mixed") + F.col("_alone")).alias("_blocks")))
    before = Window.partitionBy(group).orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    wide = per.filter("_wide IS NOT NULL").select(group, "label", "_wide", F.coalesce(F.sum("_wide").over(before), F.lit(0)).cast("int").alias("_start"))
    placed = named.join(groups, group).join(wide, [group, "label"], "left")
    start, stop = F.col("_mixed") + F.col("_start"), F.col("_mixed") + F.col("_start") + F.col("_wide")
    alone = F.col("_wide").isNotNull()
    placed = placed.withColumn("_own", F.when(alone, start + F.pmod(place, F.col("_wide"))).otherwise(F.pmod(place, F.greatest("_mixed", F.lit(1)))).cast("int"))
    every = F.sequence(F.lit(0), F.col("_blocks") - 1)
    placed = placed.withColumn("_other", F.explode(F.when(alone, F.filter(every, lambda x: (x < start) | (x >= stop))).otherwise(every)))
    placed = placed.select(group, "fp", "label", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"))
    apart = _edges(placed.join(rows.select(group, "fp", value), [group, "fp"]), group, test)
    if apart.isEmpty():
        return labels
    higher = components(apart).select(F.col("node").alias("_low"), F.col("label").alias("_high"))
    lone = apart.select(F.col("a").alias("node")).union(apart.select("b")).distinct().join(labels, "node", "left_anti")
    labels = labels.union(lone.select("node", F.col("node").alias("label")))
    return stage(labels.join(higher, F.col("label") == F.col("_low"), "left").select("node", F.coalesce("_high", "label").alias("label")))


def _edges(placed: DataFrame, group: str, test) -> DataFrame:
    met = placed.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")
    return stage(met.mapInArrow(test, "a binary, b binary").distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, percent: int = 85,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: doc_id (named as key), n_shingles, component_id (smallest id reachable over links), kept.

    Linked: shingle sets with 100 * intersection >= percent * union. Documents with equal sets form a class first; only
    classes are banded. Classes that share a band and whose signatures agree (within SLACK deviations of the
    bound) are joined to candidate clusters; each cluster's full sets are rebuilt from the texts and every pair in it is
    tested exactly, block against block. Buckets and clusters pass on stars, never all their pairs.
    Null or wordless texts have no set and link with nothing. A null id counts as smaller than all others, and such a
    component's component_id is null; repeated rows are copies. Other columns are ignored.
    """
    base = docs.select(id_key(key).alias("id"), F.col(text).alias("text"), F.lit(0).cast("long").alias("row"))
    made, named = _grouped(base, words, percent, bands, rows)
    named = named.select(F.col("fp").alias("_fp"), F.col("first.id").alias("component_id"))
    out = made.select("id", "n", "fp").join(named, (F.col("fp") == F.col("_fp")) & (F.col("n") > 0), "left")
    component = F.coalesce("component_id", "id")
    real = lambda c: F.when(c != F.lit(-(2**63)), c)
    return out.select(real(F.col("id")).alias(key), F.col("n").alias("n_shingles"), real(component).alias("component_id"),
                      (F.col("id") == component).alias("kept"))


def _grouped(base: DataFrame, words: int, percent: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Staged signatures of the rows of base (id, text, row), and per set (fp) its component's first (id, fp, row)."""
    m = bands * rows
    made = base.mapInArrow(_signatures(words, bands, rows), "id long, row long, n long, fp binary, bands array<long>, sig binary")
    made = stage(made)
    classes = made.filter("n > 0").groupBy("fp").agg(F.min(F.struct("id", "row")).alias("least"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    classes = stage(classes.select("fp", "least.id", "least.row", "bands", "sig"))
    keys = classes.select("fp", F.explode("bands").alias("bucket"))
    full = stage(keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("bucket"))
    shared = stage(keys.join(full, "bucket"))
    signed = shared.join(classes.select("fp", "sig"), "fp")
    similarity = percent / 100
    least = similarity - SLACK * math.sqrt(similarity * (1 - similarity) / m)
    clusters = _linked(stage(signed), "bucket", "sig", _agreeing(m, least))
    members = stage(clusters.join(classes.select("fp", "id", "row"), clusters["node"] == classes["fp"])
                    .select("id", "row", F.col("fp").alias("_fp"), F.xxhash64("label").alias("cluster")))
    texts = base.join(members.hint("shuffle_hash"), ["id", "row"]).select("cluster", F.col("_fp").alias("fp"), "text")
    sets = texts.mapInArrow(_checked_sets(words), "cluster long, fp binary, sets array<long>")
    sets = stage(sets.dropDuplicates(["fp"]))
    groups = _linked(sets, "cluster", "sets", _verified(percent))
    named = classes.select("fp", "id", "row").join(groups, classes["fp"] == groups["node"], "left")
    named = stage(named.select("fp", F.coalesce("label", "fp").alias("label"), "id", "row"))
    first = named.groupBy("label").agg(F.min(F.struct("id", "fp", "row")).alias("first"))
    return made, stage(named.join(first, "label").select("fp", "first"))


def _checked_sets(k: int):
    """Sets of the texts whose fingerprint is the wanted one: an id may stand for several texts if it is null or repeated."""
    schema = pa.schema([("cluster", pa.int64()), ("fp", pa.binary()), ("sets", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            cluster, fps, texts = batch.column(0), batch.column(1), batch.column(2)
            for lo, hi, data, offsets in text_chunks(texts):
                h, counts = shingle_sets(data, offsets, k)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                two = [np.concatenate([[np.uint64(0)], np.cumsum(mix(h * GOLDEN + np.uint64(c)))])[bounds] for c in (1, 2)]
                fp = np.stack([np.diff(t) for t in two], 1).tobytes()
                want = fps.slice(lo, hi - lo).to_pylist()
                good = [i for i in range(hi - lo) if fp[16 * i: 16 * i + 16] == want[i]]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(h.view(np.int64)))
                take = pa.array(good, pa.int64())
                yield pa.RecordBatch.from_arrays([cluster.slice(lo, hi - lo).take(take), pa.array([want[i] for i in good], pa.binary()), lists.take(take)],
                                                 schema=schema)
    return run


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of `near_duplicates`; all columns as they were.

    Rows are told apart by a row number, so rows that repeat an id, or have none, are documents of their own: the row of
    the smallest id stays (no id counts as smallest), then of the smallest fingerprint, then the first. Rows without a
    word link with nothing and stay.
    """
    docs = stage(docs.withColumn("_row", F.monotonically_increasing_id()))
    base = docs.select(id_key(key).alias("id"), F.col(text).alias("text"), F.col("_row").alias("row"))
    made, named = _grouped(base, words, percent, BANDS, ROWS)
    named = named.select(F.col("fp").alias("_fp"), F.col("first.row").alias("_first"))
    out = made.filter("n > 0").select("row", "fp").join(named, F.col("fp") == F.col("_fp"))
    drop = stage(out.filter("row <> _first").select(F.col("row").alias("_gone")))
    return docs.join(drop.hint("shuffle_hash"), F.col("_row") == F.col("_gone"), "left_anti").drop("_row")

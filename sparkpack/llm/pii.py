"""Personal data: exact base patterns, and bootstrapped contextual extraction of identifiers of other forms."""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpack.llm.common import GOLDEN, NOT_BLANK, byte_table, golden, mix, run_hashes, runs, stage, text_chunks

KINDS = ["email", "ip", "card", "phone"]
#: Kind of what the contexts find.
FOUND = "id"
#: A pattern is trusted from this percentage of identifiers on.
ACCEPT = 90
#: Patterns have up to so many words on a side.
REACH = 3
#: Low bits of the patterns whose other words are counted, as a table of fixed size; a join removes what only shares bits.
LOW_BITS = 1 << 20
#: Other words are first counted in one of so many parts of the texts.
PARTS = 64

#: The base patterns. A start inside a digit run fails like the run's first, so runs are tried once.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARKS = ".,;:!?\"'()[]{}<>#$%&*"
_IS_MARK = byte_table(lambda b: chr(b) in _MARKS)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address starts where the run of local characters before its @ starts; each @ is looked at once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Per base kind the matches, leftmost and not overlapping; matches that fail their test are dropped."""
    out: list[list[tuple[int, int]]] = [[], [], [], []]
    if "@" in text:
        out[0] = list(_emails(text))
    if _DIGIT.search(text):
        if "." in text:
            out[1] = [m.span() for m in _IP.finditer(text) if all(_small(p) for p in m.groups())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = _digits(m[0])
                if 16 <= len(d) <= 19 and luhn(d):
                    out[2].append(m.span())
        if "+" in text:
            out[3] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def _joined(kind: str, spans: Iterable[tuple[int, int]]) -> list[str]:
    return [f"{kind}:{a}:{b}" for a, b in spans]


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _refused(core: str) -> bool:
    """A card or address whose test failed is not offered again."""
    if all(c in "0123456789- ." for c in core):
        return len(_digits(core)) >= 16 or _IP.fullmatch(core) is not None
    return False


def places(text: str, spans: list[list[tuple[int, int]]]) -> tuple[list[tuple[int, int, bool, bool, int, int]], int]:
    """Instances in a text as (start, end, seed, mixed, first word, last word), and the text's number of words.

    Seeds are the base spans; the others are words with a digit, bare of marks, of six characters or more, that touch no
    base span; mixed ones have letters too.
    """
    words = [m.span() for m in _WORD.finditer(text)]
    if not any(spans) and not _DIGIT.search(text):
        return [], len(words)
    out, k = [], 0
    seeds = sorted(s for kind in spans for s in kind)
    starts, ends = [w[0] for w in words], [w[1] for w in words]
    for a, b in seeds:
        out.append((a, b, True, False, bisect_right(ends, a), bisect_left(starts, b) - 1))
    for at, (a, b) in enumerate(words):
        while k < len(seeds) and seeds[k][1] <= a:
            k += 1
        if k < len(seeds) and seeds[k][0] < b:
            continue
        token = text[a:b]
        core = token.strip(_MARKS)
        if len(core) >= 6 and _DIGIT.search(core) and not _refused(core):
            start = a + token.index(core)
            out.append((start, start + len(core), False, any(c.isalpha() for c in core), at, at))
    return sorted(out), len(words)


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, bare of marks (a word of marks alone stays) and with A-Z lower-cased, and its document."""
    starts, ends, doc = runs(data, offsets, NOT_BLANK)
    a, b = starts.copy(), ends.copy()
    live = np.arange(len(a))
    while len(live := live[(a[live] < b[live])][_IS_MARK[data[a[live[a[live] < b[live]]]]]]):
        a[live] += 1
    live = np.arange(len(a))
    while len(live := live[(a[live] < b[live])][_IS_MARK[data[b[live[a[live] < b[live]]] - 1]]]):
        b[live] -= 1
    bare = a < b
    return run_hashes(data, np.where(bare, a, starts), np.where(bare, b, ends)), doc


def contexts(h: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Patterns of instances over the words first .. last: hashes (instances x 2 * REACH + 2) and which of them there are.

    One to REACH words on the left, as many on the right, and one or two words on both sides together.
    """
    n = len(h)
    kinds, there = [], []
    for side, edge, step in ((1, first, -1), (2, last, 1)):
        x, ok = np.full(len(first), golden(side), np.uint64), np.ones(len(first), bool)
        for k in range(1, REACH + 1):
            at = edge + step * k
            ok = ok & (at >= 0) & (at < n)
            at = np.clip(at, 0, max(0, n - 1))
            ok = ok & (doc[at] == doc[first])
            x = mix((x ^ h[at]) + golden(k))
            kinds.append(x)
            there.append(ok)
    for k in range(2):
        kinds.append(mix(kinds[k] * GOLDEN + kinds[REACH + k]))
        there.append(there[k] & there[REACH + k])
    return np.stack(kinds, 1), np.stack(there, 1)


_SEEN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("instance", pa.int64()), ("seed", pa.bool_()), ("mixed", pa.bool_()), ("patterns", pa.list_(pa.int64()))]))
_SCAN = pa.schema([("no", pa.int64()), ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base", pa.string()), ("seen", _SEEN)])


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in text_chunks(batch.column(2)):
            part = batch.slice(lo, hi - lo)
            counts, base, seen, found, passed = [], [], [], [], 0
            for text in part.column(2).to_pylist():
                text = text or ""
                spans = base_spans(text)
                counts.append([len(s) for s in spans])
                base.append(",".join(x for kind, s in zip(KINDS, spans) for x in _joined(kind, s)))
                here, n = places(text, spans)
                seen.append([{"start": a, "end": b, "instance": _hash(text[a:b].lower()), "seed": seed, "mixed": mixed} for a, b, seed, mixed, _, _ in here])
                found += [(passed + i, passed + j) for *_, i, j in here]
                passed += n
            if found:
                at = np.array(found, np.int64)
                kinds, there = contexts(*_word_hashes(data, offsets), at[:, 0], at[:, 1])
                rows = iter(zip(kinds.view(np.int64), there))
                for o in (o for os in seen for o in os):
                    k, ok = next(rows)
                    o["patterns"] = k[ok].tolist()
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(4)],
                                              pa.array(base, pa.string()), pa.array(seen, _SEEN)], schema=_SCAN)


def _other_words(wanted: np.ndarray):
    """Per chunk of texts the distinct (pattern, word) of words that are no instance, of patterns whose low bits are wanted."""
    schema = pa.schema([("pattern", pa.int64()), ("word", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(0)):
                h, doc = _word_hashes(data, offsets)
                taken, passed = np.zeros(len(h), bool), 0
                for text in batch.column(0).slice(lo, hi - lo).to_pylist():
                    here, n = places(text or "", base_spans(text or ""))
                    for *_, i, j in here:
                        taken[passed + i: passed + j + 1] = True
                    passed += n
                words = np.flatnonzero(~taken)
                if not len(words):
                    continue
                kinds, there = contexts(h, doc, words, words)
                row, col = np.nonzero(there & wanted[(kinds & np.uint64(len(wanted) - 1)).astype(np.int64)])
                pairs = np.unique(np.stack([kinds[row, col], h[words[row]]], 1), axis=0).view(np.int64)
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)
    return run


def other_words(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """Per pattern the number of distinct words in it that are no instance (n_other); patterns without one have no row."""
    low = [r[0] for r in patterns.select(F.pmod("pattern", F.lit(LOW_BITS))).distinct().collect()]
    wanted = np.zeros(LOW_BITS, bool)
    wanted[low] = True
    pairs = texts.mapInArrow(_other_words(wanted), "pattern long, word long").join(patterns, "pattern", "left_semi")
    return pairs.distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("n_other"))


def trusted_patterns(edges: DataFrame, others: DataFrame) -> DataFrame:
    """Patterns to trust, from distinct edges (instance, seed, mixed, pattern) and the number of other words in a pattern.

    A pattern is trusted if ACCEPT percent of the distinct words and instances in it, and one doubtful one, are identifiers.
    Seeds always are. Mixed instances count as such until no trusted pattern is left around them; numbers,
    dates and amounts only once a trusted pattern holds them. First patterns are dropped until none changes, then added
    until none changes; both only go one way, so both end.
    """
    first = edges.withColumn("right", F.col("seed") | F.col("mixed"))
    edges = stage(first.join(others, "pattern", "left").withColumn("n_other", F.coalesce("n_other", F.lit(0).cast("long"))))

    def of(rows: DataFrame) -> DataFrame:
        counts = rows.groupBy("pattern").agg(F.sum(F.col("right").cast("long")).alias("good"), F.count(F.lit(1)).alias("n"), F.max("n_other").alias("o"))
        return stage(counts.filter(F.col("good") * 100 >= ACCEPT * (F.col("n") + F.col("o") + 1)).select("pattern"))

    trusted = of(edges)
    for rising in (False, True):
        while True:
            held = edges.join(trusted, "pattern", "left_semi").select("instance").distinct().withColumn("held", F.lit(True))
            right = F.col("seed") | (F.col("held") if rising else F.col("held") & F.col("mixed"))
            rows = edges.drop("right").join(held, "instance", "left").withColumn("held", F.coalesce("held", F.lit(False)))
            after = of(rows.withColumn("right", right))
            if after.count() == trusted.count():
                break
            trusted = after
    return trusted


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every whole text.

    spans: kind:start:end in code points, end exclusive, by kind (email, ip, card, phone, then id for what contexts found)
    and start, joined by commas; base_sha256 is the hash of the base part alone. Null text counts as empty. Patterns
    are the one to three words on a side and the one or two on both; all words that a pattern holds in the corpus count
    for or against it, and another word with digits becomes an id where a trusted pattern stands around it.
    Repeated rows are scanned each; other columns are ignored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("no"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    kind = "array<struct<start:long,end:long,instance:long,seed:boolean,mixed:boolean,patterns:array<long>>>"
    base = stage(rows.mapInArrow(_scan, f"no long, doc_id long, {counts}, base string, seen {kind}"))
    seen = base.filter(F.size("seen") > 0).select("no", F.explode("seen").alias("o")).select("no", "o.*")
    edges = stage(seen.select("instance", "seed", "mixed", F.explode("patterns").alias("pattern")).groupBy("instance", "pattern")
                  .agg(F.max("seed").alias("seed"), F.max("mixed").alias("mixed")))
    # a pattern of fewer instances can't reach the percentage, one without candidates has nothing to decide
    enough = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.min("seed").alias("all"))
    enough = stage(enough.filter((F.col("n") * 100 >= ACCEPT * (F.col("n") + 1)) & ~F.col("all")).select("pattern", "n"))
    # what too many other words of a part of the texts rule out, the whole can't bring back
    some = F.pmod(F.xxhash64(text), F.lit(PARTS)) == 0
    for texts in (docs.filter(some), docs):
        others = stage(other_words(texts.select(F.col(text).alias("text")), enough))
        open_ = enough.join(others, "pattern", "left").withColumn("n_other", F.coalesce("n_other", F.lit(0).cast("long")))
        enough = stage(open_.filter(F.col("n") * 100 >= ACCEPT * (F.col("n") + F.col("n_other") + 1)).select("pattern", "n"))
    trusted = trusted_patterns(edges.join(enough, "pattern", "left_semi"), others)
    around = seen.filter("not seed").select("no", "start", "end", F.explode("patterns").alias("pattern"))
    more = around.join(trusted, "pattern", "left_semi").select("no", "start", "end").distinct()
    place = F.concat_ws(":", F.lit(FOUND), F.col("start").cast("string"), F.col("end").cast("string"))
    # the two lists of a document meet on its row number, which the scan wrote down
    more = more.groupBy(F.col("no").alias("_no")).agg(F.array_sort(F.collect_list(F.struct("start", place.alias("s")))).alias("found"))
    out = base.drop("seen").join(stage(more), F.col("no") == F.col("_no"), "left")
    extra = F.array_join(F.transform("found", lambda x: x["s"]), ",")
    spans = F.when(F.col("found").isNull(), F.col("base")).when(F.col("base") == "", extra).otherwise(F.concat_ws(",", "base", extra))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"))

"""Language ID by rank-order n-gram profiles and out-of-place distance."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.llm.common import text_chunks

#: n-grams of a profile, of 1 to 3 characters; the same number is taken of a document.
PROFILE = 400
UNKNOWN = "und"

_letters: np.ndarray | None = None


def letter_codes() -> np.ndarray:
    """Code point to 16-bit code of its lower-case letter, 0 for anything else. Letters past 16 bits share codes."""
    global _letters
    if _letters is None:
        _letters = np.zeros(0x110000, np.uint32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = ord(c.lower()[0])
                _letters[cp] = low if low < 0x10000 else 0xE000 + low % 0x1800
    return _letters


def ngram_counts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per document with a letter: its number, its n-grams (codes packed 16 bits each) and their counts.

    Words are runs of letters with a blank on either side; n-grams are of 1 to 3 characters within a word and its blanks.
    """
    table = letter_codes()
    for d in range(len(offsets) - 1):
        text = data[offsets[d]: offsets[d + 1]].tobytes().decode("utf-8", "replace")
        codes = table[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        if not codes.any():
            continue
        # one blank (code 1) between words and at both ends
        codes = np.concatenate([[np.uint32(0)], codes, [np.uint32(0)]])
        codes = codes[(codes > 0) | np.concatenate([[True], codes[:-1] > 0])]
        codes = np.where(codes == 0, np.uint64(1), codes.astype(np.uint64))
        if codes[0] != 1:
            codes = np.concatenate([[np.uint64(1)], codes])
        if codes[-1] != 1:
            codes = np.concatenate([codes, [np.uint64(1)]])
        s = np.uint64(16)
        two = (codes[:-1] << s) | codes[1:]
        three = (two[:-1] << s) | codes[2:]
        three = three[codes[1:-1] != 1]
        grams = np.concatenate([codes[codes != 1], two, three])
        grams.sort()
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        yield d, grams[first], np.diff(np.concatenate([first, [len(grams)]]))


def top(grams: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent n-grams, most frequent first; ties by code."""
    if len(grams) > k:
        least = np.partition(counts, len(counts) - k)[len(counts) - k]
        near = counts >= least
        grams, counts = grams[near], counts[near]
    return grams[np.argsort(-counts, kind="stable")[:k]]


def _counted():
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            parts: dict[str, list] = {}
            for lo, _, data, offsets in text_chunks(batch.column(1)):
                for d, grams, counts in ngram_counts(data, offsets):
                    parts.setdefault(langs[lo + d], []).append((grams, counts))
            for lang, some in parts.items():
                grams, at = np.unique(np.concatenate([g for g, _ in some]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in some])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)), pa.array(n)], schema=schema)
    return run


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """Each language's most frequent n-grams over all its documents, most frequent first, ties by code.

    Counts are summed per task before the shuffle, and only the best `size` per task and language reach the ranking. The
    driver gets size numbers per language. Rows without a language are not learned from.
    """
    counted = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counted = counted.mapInArrow(_counted(), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    found: dict[str, list[tuple[int, int]]] = {}
    for r in best.select("lang", "gram", "rank").collect():
        found.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return {k: [g for _, g in sorted(v)] for k, v in sorted(found.items())}


def distances(grams: np.ndarray, table: np.ndarray, ranks: np.ndarray, size: int) -> np.ndarray:
    """Out-of-place distance of a ranked list to every profile: the difference in rank of each n-gram, `size` if it is missing.

    table: all n-grams of the profiles, sorted; ranks: (languages x table), `-1` where missing.
    """
    at = np.minimum(np.searchsorted(table, grams), len(table) - 1)
    r = np.where(table[at] == grams, ranks[:, at], -1)
    off = np.abs(r - np.arange(len(grams)))
    return np.where(r < 0, size, off).sum(axis=1)


def _predicted(profiles: dict[str, list[int]], size: int):
    langs = list(profiles)
    table = np.unique(np.array([g for p in profiles.values() for g in p], np.int64).view(np.uint64)) if langs else np.zeros(0, np.uint64)
    ranks = np.full((len(langs), len(table)), -1, np.int64)
    for i, p in enumerate(profiles.values()):
        ranks[i, np.searchsorted(table, np.array(p, np.int64).view(np.uint64))] = np.arange(len(p))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            pred, score = [UNKNOWN] * n, [0.0] * n
            for lo, _, data, offsets in text_chunks(batch.column(2)) if langs else []:
                for d, grams, counts in ngram_counts(data, offsets):
                    best = top(grams, counts, size)
                    far = distances(best, table, ranks, size)
                    order = np.argsort(far, kind="stable")
                    pred[lo + d] = langs[order[0]]
                    # how much nearer the best profile is than the next
                    rest = far[order[1]] if len(order) > 1 else size * len(best)
                    score[lo + d] = float(1 - far[order[0]] / rest) if rest else 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred), pa.array(score, pa.float64())], schema=schema)
    return run


def identify_languages(docs: DataFrame, profiles: dict[str, list[int]], held_out: Column, key: str = "doc_id", text: str = "text",
                       size: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text: the language whose profile is nearest, ties by name.

    score is the margin to the second nearest (0 to 1). Null texts, texts without a letter and empty models give `und`
    with 0. Only the text is read for a prediction; repeated rows are predicted each, other columns are ignored.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(_predicted(profiles, size), "doc_id long, held_out boolean, lang_pred string, score double")

"""Target-distribution importance resampling: hashed features, log ratios, Gumbel noise, the best scores drawn exactly."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.llm.common import runs, stage
from sparkpack.llm.terms import WORD, run_crcs, text_slices

BUCKETS = 10_000
#: Thresholds one counting job tries at once.
PROBES = 15
LAST = 2**63 - 1


def _bucket_counts(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, offsets, _ in text_slices(batch.column(0), WORD):
                starts, ends, _ = runs(data, offsets, WORD)
                total += np.bincount(run_crcs(data, starts, ends) % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many words of all whole texts fall into each bucket; summed per task first."""
    some = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(_bucket_counts(buckets), "bucket long, n long")
    return some.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket floor(1000 * log ratio) of target to raw frequency, each smoothed by one. The driver gets `buckets` numbers."""
    every = raw.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(raw.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0)
    total = F.struct(F.sum("s").alias("s"), F.sum("t").alias("t"))
    both = both.crossJoin(F.broadcast(both.agg(total.alias("all"))))            # one row
    ratio = ((F.col("t") + 1).cast("double") * (F.col("all.s") + buckets)) / ((F.col("s") + 1).cast("double") * (F.col("all.t") + buckets))
    out = np.zeros(buckets, np.int64)
    for r in both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect():
        out[r["bucket"]] = r["gain"]
    return out


def _weights(gain: np.ndarray):
    schema = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(batches):
        for batch in batches:
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for lo, data, offsets, _ in text_slices(batch.column(1), WORD):
                starts, ends, doc = runs(data, offsets, WORD)
                if len(doc):
                    own = gain[run_crcs(data, starts, ends) % len(gain)]
                    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                    n[lo + doc[first]] += np.diff(np.concatenate([first, [len(doc)]]))
                    total[lo + doc[first]] += np.add.reduceat(own, first)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(weight)], schema=schema)
    return run


def noise(seed: int, key: Column) -> Column:
    """floor(1000 * Gumbel noise) of a document: a function of seed and id only."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def least_reaching(rows: DataFrame, value: Column, wanted: int) -> tuple[int, int]:
    """The smallest x such that at least `wanted` rows have value <= x, and how many lie below it.

    Bisection by whole numbers: each job counts the rows under PROBES thresholds exactly, so 64 bits take at most 16 jobs.
    """
    ends = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi, below = ends["lo"], ends["hi"], 0                        # x is in [lo, hi]; `below` rows lie under lo
    while lo < hi:
        step = (hi - lo + PROBES) // (PROBES + 1)
        marks = sorted({min(hi, lo + step * i - 1) for i in range(1, PROBES + 1)} - {hi})
        at = rows.agg(*[F.count(F.when(value <= m, 1)).alias(f"m{i}") for i, m in enumerate(marks)]).first()
        for i, m in enumerate(marks):
            if at[f"m{i}"] >= wanted:
                hi = m
                break
            lo, below = m + 1, at[f"m{i}"]
    return lo, below


def drawn(scored: DataFrame, wanted: int) -> DataFrame:
    """The `wanted` best rows of a stored table: score descending, then id, then row. Nothing is sorted to find them."""
    if wanted <= 0:
        return scored.filter(F.lit(False))
    ident = F.coalesce(F.col("doc_id"), F.lit(LAST))
    rows, edge = scored, []                                         # rows tied so far; (value, threshold) of each step
    for value in (-F.col("score"), ident, F.col("row")):
        at, below = least_reaching(rows, value, wanted)
        edge.append((value, at))
        rows, wanted = rows.filter(value == at), wanted - below
    (a, x), (b, y), (c, z) = edge
    return scored.filter((a < x) | ((a == x) & ((b < y) | ((b == y) & (c <= z)))))


def ranked(rows: DataFrame) -> DataFrame:
    """row, rank: 1, 2, 3... by score descending, id, row. Ranges of the order are numbered on their own; only their sizes meet."""
    order = [F.desc("score"), F.coalesce(F.col("doc_id"), F.lit(LAST)), F.col("row")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))            # one row a partition
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return dealt.withColumn("_in", inside).join(starts, "part").select("row", (F.col("start") + F.col("_in")).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, seed: int = 2024, percent: int = 10, least_words: int = 20, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where it is not drawn.

    Features are the lower-cased words, hashed to buckets; a document's weight is the floored mean of its words' log ratios
    between the texts of `target` and all documents, its score adds seeded noise. Of the documents with at least `least_words`
    words, floor(percent %) are drawn by score, ties to the smaller id.

    Null and empty texts have no features and weight 0. A null id takes the noise of an empty one and loses ties. Rows that
    repeat an id count and are drawn each, in stored order. Empty tables are allowed on either side; other columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(slim, buckets=buckets), bucket_counts(target, buckets=buckets), buckets)
    scored = slim.mapInArrow(_weights(gain), "doc_id long, n_features long, weight long")
    scored = scored.withColumn("score", F.col("weight") + noise(seed, F.col("doc_id"))).withColumn("row", F.monotonically_increasing_id())
    scored = stage(scored)
    able = scored.filter(F.col("n_features") >= least_words)
    ranks = ranked(drawn(able, percent * able.count() // 100).select("doc_id", "score", "row"))
    return scored.join(ranks, "row", "left").drop("row")

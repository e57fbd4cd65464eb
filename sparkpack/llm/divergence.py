"""Source divergence audit: a K-squared quadtree over the group-term count matrix, traversed jointly for pairs of groups."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.llm.common import running, stage
from sparkpack.llm.terms import TERM, counted, distinct_runs, text_slices

#: Smoothing added to every count, and the integer scale of a probability.
SMOOTH, SCALE = 5, 1_000_000_000
#: K of the quadtree: a region splits into K x K quadrants, twice, down to leaves of one group and LEAF terms.
K, LEAF = 8, 64
ROWS, COLS = K * K, K * K * LEAF


def _partial_counts():
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple, int] = {}
            of = np.array([groups.setdefault(k, len(groups)) for k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.int64)
            langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))

            def rows(group, n, docs, terms):
                cols = [langs.take(pa.array(group)), sources.take(pa.array(group)), terms, pa.array(n), pa.array(docs)]
                return pa.RecordBatch.from_arrays(cols, schema=schema)

            begun: dict[str, int] = {}          # terms of a text that comes in several slices
            for lo, data, offsets, more in text_slices(batch.column(2), TERM):
                doc, term, terms = distinct_runs(data, offsets, TERM)
                if more or begun:
                    key, n = counted(term)
                    for t, c in zip(terms.take(pa.array(key)).to_pylist(), n.tolist()):
                        begun[t] = begun.get(t, 0) + c
                    if not more:
                        group = np.full(len(begun), of[lo])
                        yield rows(group, np.array(list(begun.values()), np.int64), np.ones(len(begun), np.int64), pa.array(list(begun), pa.string()))
                        begun = {}
                    continue
                if not len(doc):
                    continue
                key, n = counted(doc * len(terms) + term)
                pair = of[lo + key // len(terms)] * len(terms) + key % len(terms)
                cell, total = counted(pair, n)
                _, docs = counted(pair)
                yield rows(cell // len(terms), total.astype(np.int64), docs.astype(np.int64), terms.take(pa.array(cell % len(terms))))
    return run


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it) of whole texts, summed in tasks before the shuffle."""
    some = docs.select("lang", "source", "text").mapInArrow(_partial_counts(), "lang string, source string, term string, n long, docs long")
    return some.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * kept)), exact beyond 64 bits."""
    above = (n + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", above, (total + SMOOTH * kept).cast("decimal(20,0)"))


# The joint traversal ----------------------------------------------------------------------------------------------

class Quadtree:
    """One region of the matrix: ROWS groups by COLS terms. Nonzero cells as (row, column, p); `zero` is each row's p of an absent term.

    top and low tell which quadrants of the first and second split hold a cell; leaves are rows of LEAF values.
    """

    def __init__(self, row: np.ndarray, col: np.ndarray, p: np.ndarray, zero: np.ndarray):
        self.zero = zero
        self.low = np.zeros((len(zero), K * K), bool)
        self.low[row, col // LEAF] = True
        self.top = np.array([[self.low[i: i + K, j * K: (j + 1) * K].any() for j in range(K)] for i in range(0, len(zero), K)])
        order = np.argsort(col // LEAF, kind="stable")
        self.row, self.col, self.p = row[order], col[order], p[order]
        self.cut = np.searchsorted(self.col // LEAF, np.arange(K * K + 1))

    def leaves(self, j: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows with a leaf in column block j, and their values."""
        some = slice(self.cut[j], self.cut[j + 1])
        rows, at = np.unique(self.row[some], return_inverse=True)
        values = np.repeat(self.zero[rows][:, None], width, axis=1)
        values[at, self.col[some] - j * LEAF] = self.p[some]
        return rows, values


def joint_sums(a: Quadtree, b: Quadtree, columns: int) -> np.ndarray:
    """Sum of |p - q| over the columns of a region for every row of a with every row of b.

    Quadrants that are zero in both are priced by their number of columns; the rest descends to leaves.
    """
    apart = np.abs(a.zero[:, None] - b.zero[None, :])
    uniform = np.zeros_like(apart)                                   # columns where both are zero
    sums = np.zeros_like(apart)
    for t in range(K):
        wide = min(K * LEAF, columns - t * K * LEAF)
        if wide <= 0:
            break
        if not (a.top[:, t].any() or b.top[:, t].any()):
            uniform += wide
            continue
        for j in range(t * K, (t + 1) * K):
            width = min(LEAF, columns - j * LEAF)
            if width <= 0:
                break
            ra, x = a.leaves(j, width)
            rb, y = b.leaves(j, width)
            za, zb = np.flatnonzero(~a.low[:, j]), np.flatnonzero(~b.low[:, j])
            uniform[np.ix_(za, zb)] += width
            for i, row in zip(ra, x):                                # a leaf against leaves, then against zero rows
                sums[i, rb] += np.abs(y - row).sum(axis=1)
                sums[i, zb] += np.abs(b.zero[zb][:, None] - row).sum(axis=1)
            for i, row in zip(rb, y):
                sums[za, i] += np.abs(a.zero[za][:, None] - row).sum(axis=1)
    return sums + uniform * apart


def _traversed():
    schema = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64()), ("columns", pa.int64())])

    def tree(cells, zero):
        got = np.array([[c["row"], c["col"], c["p"]] for c in cells or []], np.int64).reshape(-1, 3)
        return Quadtree(got[:, 0], got[:, 1], got[:, 2], np.array(zero, np.int64))

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                a = tree(r["a_cells"], r["a_zero"])
                b = a if r["i"] == r["j"] else tree(r["b_cells"], r["b_zero"])
                sums = joint_sums(a, b, r["columns"])
                x, y = np.indices(sums.shape)
                x, y = x + r["i"] * ROWS, y + r["j"] * ROWS
                use = (x < y).ravel()
                n = int(use.sum())
                yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * n, pa.string()), pa.array(x.ravel()[use]), pa.array(y.ravel()[use]),
                                                  pa.array(sums.ravel()[use]), pa.array(np.full(n, r["columns"]))], schema=schema)
    return run


def _pair_values(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (numbers of groups, a < b), value over the regions that hold a cell of either, and their columns.

    cells: lang, row, col, p; groups: lang, row, zero, kept. Each region of a band of ROWS groups is one row that goes to every
    pair its band is in; the pairs of bands follow the pairs of groups in the result.
    """
    band = lambda c: F.floor(c / ROWS).cast("long")
    bands = groups.groupBy("lang", band(F.col("row")).alias("i")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("row", "zero"))), lambda x: x["zero"]).alias("zero"), F.first("kept").alias("kept"))
    bands = stage(bands)
    regions = cells.groupBy("lang", band(F.col("row")).alias("i"), F.floor(F.col("col") / COLS).cast("long").alias("k")).agg(
        F.collect_list(F.struct((F.col("row") % ROWS).cast("int").alias("row"), (F.col("col") % COLS).cast("int").alias("col"), "p")).alias("cells"))
    regions = stage(regions)
    other = bands.select(F.col("lang").alias("_lang"), F.col("i").alias("_i"), F.col("zero").alias("_zero"))
    own = regions.join(bands, ["lang", "i"]).join(other, F.col("lang") == F.col("_lang"))
    first = F.col("i") <= F.col("_i")
    sides = own.select(
        "lang", F.least("i", "_i").alias("i"), F.greatest("i", "_i").alias("j"), "k",
        F.least(F.lit(COLS), F.col("kept") - F.col("k") * COLS).cast("long").alias("columns"),
        F.when(first, F.col("zero")).otherwise(F.col("_zero")).alias("a_zero"), F.when(first, F.col("_zero")).otherwise(F.col("zero")).alias("b_zero"),
        F.when(first, F.col("cells")).alias("a_cells"), F.when(~first, F.col("cells")).alias("b_cells"))
    units = sides.groupBy("lang", "i", "j", "k").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("columns", "a_zero", "b_zero", "a_cells", "b_cells")])
    found = units.select("lang", "i", "j", "columns", "a_zero", "b_zero", "a_cells", "b_cells").mapInArrow(
        _traversed(), "lang string, a long, b long, value long, columns long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("columns").alias("columns"))


def audit_sources(docs: DataFrame, least_docs: int = 30, best: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: how the sources of each language differ in their use of words.

    A language keeps the terms (runs of letters and non-ASCII characters, A-Z lower-cased) that at least `least_docs` of its
    documents hold. Part `pair` ranks the other sources of the language by the sum of |p - q| over all kept terms, part
    `term` the `best` terms a source uses more than its language does, by p - q; p and q are smoothed integer
    probabilities. Ranks go by value descending, then item.

    Null text, lang and source are ''. Groups without a kept term appear in `pair`; without kept terms every value is 0.
    Repeated rows count each; other columns are ignored; no documents give no rows.

    Columns of the matrix are ordered by frequency class, so that rare terms share quadrants most groups leave empty.
    Counts meet by (lang, term) and (lang, source) in Spark; a task holds one region of at most ROWS x COLS cells and its
    partner.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    cells = stage(term_counts(docs))
    kept = cells.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("_docs")).filter(F.col("_docs") >= least_docs).drop("_docs")
    level, spread = F.floor(-4 * F.log2("total")).cast("long"), F.pmod(F.xxhash64("term"), F.lit(256))
    kept = kept.withColumn("_level", level).withColumn("_spread", spread)
    order = [F.col("_level"), F.col("_spread"), F.col("term")]
    kept = stage(running(kept, ["lang"], (F.col("_level") + 256) * 256 + F.col("_spread"), order, F.lit(1), 65536, "col").drop("_level", "_spread"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("all"))
    cells = stage(cells.drop("docs").join(kept, ["lang", "term"]))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = docs.groupBy("lang", "source").agg(F.lit(1).alias("_one")).drop("_one").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("size", "kept", "all")])
    zero = F.when(F.col("kept") > 0, probability(F.lit(0).cast("long"), F.col("size"), F.col("kept"))).otherwise(F.lit(0).cast("long"))
    row = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("size"), "source")) - 1
    groups = stage(groups.withColumn("zero", zero).withColumn("row", row.cast("long")))
    p = probability(F.col("n"), F.col("size"), F.col("kept"))
    cells = stage(cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "row", "col", p.alias("p"), probability(F.col("total"), F.col("all"), F.col("kept")).alias("q")))

    over = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(over)).filter(F.col("rank") <= best)

    found = stage(_pair_values(cells.select("lang", "row", "col", "p"), groups.select("lang", "row", "zero", "kept")))
    found = found.select(F.col("lang").alias("_lang"), "a", "b", F.col("value").alias("seen"), "columns")
    mine = groups.select("lang", "source", "row", "zero", "kept")
    others = groups.select("lang", F.col("source").alias("item"), F.col("row").alias("_row"), F.col("zero").alias("_zero"))
    both = mine.join(others, "lang").filter(F.col("row") != F.col("_row"))
    both = both.join(found, (F.col("lang") == F.col("_lang")) & (F.least("row", "_row") == F.col("a")) & (F.greatest("row", "_row") == F.col("b")), "left")
    # regions that neither group touches are uniform zeros
    left = F.col("kept") - F.coalesce("columns", F.lit(0).cast("long"))
    value = F.coalesce("seen", F.lit(0).cast("long")) + left * F.abs(F.col("zero") - F.col("_zero"))
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(over))
    return pairs.unionByName(terms)

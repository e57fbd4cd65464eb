"""Embedding near-dedup by an epsilon grid order join."""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpack.llm.common import Sets, components, id_key, lists_to_arrays, sorted_groups, stage

#: Leading principal dimensions of the grid, and those bounding boxes have.
GRID, BOX = 4, 8
#: Vectors of a leaf interval, and of an interval of the task-side recursion at which products are taken.
LEAF, SMALL = 512, 64
_SLACK = 1e-9


def _moments():
    schema = pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.float64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            x, at = lists_to_arrays(pa.chunked_array([batch.column(0)]), np.float64)
            dims = np.diff(at)
            for dim in np.unique(dims).tolist():
                rows = x[np.repeat(dims == dim, dims)].reshape(-1, dim)
                rows = rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
                n, s = total.setdefault(dim, [0, np.zeros((dim + 1, dim))])
                total[dim][0] = n + len(rows)
                s[0] += rows.sum(axis=0)
                s[1:] += rows.T @ rows
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t[0] for t in total.values()], pa.int64()),
                                              pa.array([t[1].ravel().tolist() for t in total.values()], pa.list_(pa.float64()))], schema=schema)
    return run


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension count: the leading principal axes (columns) of the unit vectors; the moments have dim * (dim + 1) numbers."""
    sums = vectors.select("embedding").mapInArrow(_moments(), "dim int, n long, sums array<double>")
    sums = sums.select("dim", "n", F.posexplode("sums")).groupBy("dim", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("s"))
    found: dict[int, np.ndarray] = {}
    count: dict[int, int] = {}
    for r in sums.collect():
        found.setdefault(r["dim"], np.zeros((r["dim"] + 1) * r["dim"]))[r["pos"]] = r["s"]
        count[r["dim"]] = r["n"]
    axes = {}
    for dim, s in found.items():
        s = s.reshape(dim + 1, dim) / count[dim]
        _, vectors_ = np.linalg.eigh(s[1:] - np.outer(s[0], s[0]))
        axes[dim] = vectors_[:, ::-1][:, :BOX].copy()
    return axes


def _rotated(axes: dict[int, np.ndarray]):
    schema = pa.schema([("cls", pa.int64()), ("grp", pa.int64()), ("embedding", pa.list_(pa.float32())), ("p", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            x, at = lists_to_arrays(pa.chunked_array([batch.column("embedding")]), np.float64)
            dims = np.diff(at)
            out = np.zeros((len(dims), BOX))
            for dim in np.unique(dims).tolist():
                mine = dims == dim
                rows = x[np.repeat(mine, dims)].reshape(-1, dim)
                rows = rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
                q = rows @ axes[dim]
                out[mine, : q.shape[1]] = q
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(dims) + 1, dtype=np.int32) * BOX), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("grp"), batch.column("embedding"), lists], schema=schema)
    return run


def _far(lo_a, hi_a, lo_b, hi_b, eps2: float) -> bool:
    gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return float(gap @ gap) > eps2


def ego_join(p, unit, a: tuple[int, int], b: tuple[int, int], eps2: float, least: float, hit) -> None:
    """Recursive join of two intervals of grid-ordered vectors: halves whose boxes lie too far apart are skipped, small ones multiplied."""
    (a0, a1), (b0, b1) = a, b
    if a0 == a1 or b0 == b1 or _far(p[a0:a1].min(0), p[a0:a1].max(0), p[b0:b1].min(0), p[b0:b1].max(0), eps2):
        return
    if a1 - a0 <= SMALL and b1 - b0 <= SMALL:
        x, y = np.nonzero(unit[a0:a1] @ unit[b0:b1].T >= least)
        if a == b:
            x, y = x[x < y], y[x < y]
        hit(x + a0, y + b0)
        return
    am, bm = (a0 + a1) // 2, (b0 + b1) // 2
    if a == b:
        for x, y in (((a0, am), (a0, am)), ((a0, am), (am, a1)), ((am, a1), (am, a1))):
            ego_join(p, unit, x, y, eps2, least, hit)
    elif a1 - a0 > SMALL:
        for x in ((a0, am), (am, a1)):
            ego_join(p, unit, x, b, eps2, least, hit)
    else:
        for y in ((b0, bm), (bm, b1)):
            ego_join(p, unit, a, y, eps2, least, hit)


def _joined(least: float):
    """A pair of leaves: per vector the copies it is linked to, and a spanning forest of the links (other >= 0)."""
    schema = pa.schema([("cls", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])
    eps2 = 2 - 2 * least + _SLACK

    def run(batches):
        for group in sorted_groups(batches, ["grp", "pair"]):
            group = group.sort_by([("side", "ascending"), ("at", "ascending")])
            side, cls, copies = (group.column(c).to_numpy() for c in ("side", "cls", "copies"))
            x, bounds = lists_to_arrays(group.column("embedding"), np.float64)
            unit = x.reshape(len(cls), -1)
            unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
            p, _ = lists_to_arrays(group.column("p"), np.float64)
            p = p.reshape(len(cls), -1)
            cut = int((side == 0).sum())
            links, sets, edges = np.zeros(len(cls), np.int64), Sets(len(cls)), []

            def hit(i, j):
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                for a, b in zip(i.tolist(), j.tolist()):
                    if sets.join(a, b):
                        edges.append((int(cls[a]), int(cls[b])))

            if cut == len(cls):
                ego_join(p, unit, (0, cut), (0, cut), eps2, least, hit)
            else:
                ego_join(p, unit, (0, cut), (cut, len(cls)), eps2, least, hit)
            got = np.flatnonzero(links)
            if len(got):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([cls[got], [a for a, _ in edges]]).astype(np.int64)),
                                                  pa.array(np.concatenate([np.full(len(got), -1), [b for _, b in edges]]).astype(np.int64)),
                                                  pa.array(np.concatenate([links[got], np.zeros(len(edges))]).astype(np.int64))], schema=schema)
    return run


def _gap2(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
    one = lambda x, y: F.greatest(F.lit(0.0), x - y)
    gaps = F.zip_with(F.zip_with(lo_a, hi_b, one), F.zip_with(lo_b, hi_a, one), lambda x, y: F.greatest(x, y))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g)


def _leaf_pairs(leaves: DataFrame, eps2: float) -> DataFrame:
    """Pairs of leaf intervals that may hold links: a recursion from each group's whole sequence down to halves, skipping far boxes.

    leaves: grp, leaf, lo, hi (arrays). Level by level only pairs of intervals whose boxes are near survive.
    """
    tree = [stage(leaves)]
    while True:
        top = tree[-1]
        if top.filter("leaf > 0").isEmpty():
            break
        boxes = lambda f, c: F.array(*[f(F.col(c)[k]) for k in range(BOX)]).alias(c)
        tree.append(stage(top.groupBy("grp", F.shiftright("leaf", 1).alias("leaf")).agg(boxes(F.min, "lo"), boxes(F.max, "hi"))))
    pairs = tree[-1].select("grp", F.col("leaf").alias("a"), F.col("leaf").alias("b"))
    for level in reversed(tree[:-1]):
        child = F.array(*[F.struct((2 * F.col("a") + i).alias("a"), (2 * F.col("b") + j).alias("b")) for i in (0, 1) for j in (0, 1)])
        pairs = pairs.select("grp", F.explode(child).alias("c")).select("grp", "c.a", "c.b").filter("a <= b")
        left = level.select("grp", F.col("leaf").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"))
        right = level.select("grp", F.col("leaf").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
        pairs = pairs.join(left, ["grp", "a"]).join(right, ["grp", "b"])
        pairs = stage(pairs.filter(_gap2(F.col("lo_a"), F.col("hi_a"), F.col("lo_b"), F.col("hi_b")) <= eps2).select("grp", "a", "b"))
    return pairs


def near_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label", least: float = 0.98) -> DataFrame:
    """Per vector: its id, n_links (other vectors of its label with cosine >= least), component_id (smallest id reachable), kept.

    Equal vectors of a label form a class that is compared once. Classes are sorted by the cells (width epsilon, the distance of
    unit vectors at that cosine) of their leading principal coordinates and cut into leaf intervals; pairs of
    intervals whose bounding boxes lie more than epsilon apart are skipped on every level, and the rest are
    joined recursively with products in double precision. A pair of leaves passes on counts and a spanning forest, not its links.
    Null labels, null or zero vectors and vectors with null or non-finite components link with nothing; vectors of
    different length neither. A null id counts as smaller than all others; repeated rows are copies.
    """
    x = F.col(embedding)
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = F.coalesce(F.col(label).isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = vectors.select(id_key(key).alias("id"), F.col(label).cast("string").alias("label"), x.cast("array<float>").alias("embedding"),
                          good.alias("good"))
    rows = stage(rows.withColumn("no", F.monotonically_increasing_id()).withColumn("grp", F.xxhash64("label", F.size("embedding"))))
    usable = rows.filter("good")
    classes = stage(usable.groupBy("grp", "label", "embedding").agg(F.min("no").alias("cls"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("id")))
    axes = principal_axes(classes)
    eps = math.sqrt(2 - 2 * least + _SLACK)
    placed = classes.select("cls", "grp", "embedding").mapInArrow(_rotated(axes), "cls long, grp long, embedding array<float>, p array<double>")
    cells = [F.floor(F.col("p")[k] / F.lit(eps)).alias(f"c{k}") for k in range(GRID)]
    order = ["grp", *[f"c{k}" for k in range(GRID)], "p0", "cls"]
    placed = placed.select("*", *cells, F.col("p")[0].alias("p0")).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("at", F.monotonically_increasing_id()).drop(*order[1:-1]))
    # leaves: stretches of the order; numbered within their group without gaps
    cut = stage(placed.groupBy("grp", F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("low")))
    placed = placed.join(cut, (placed["grp"] == cut["grp"]) & (F.shiftright(placed["at"], 33) == cut["part"])).drop(cut["grp"])
    placed = placed.withColumn("stretch", F.col("part") * (1 << 33) + F.floor((F.col("at") - F.col("low")) / LEAF))
    boxes = stage(placed.groupBy("grp", "stretch").agg(F.array(*[F.min(F.col("p")[k]) for k in range(BOX)]).alias("lo"),
                                                       F.array(*[F.max(F.col("p")[k]) for k in range(BOX)]).alias("hi")))
    leaves = stage(boxes.withColumn("leaf", F.row_number().over(Window.partitionBy("grp").orderBy("stretch")).cast("long") - 1))
    pairs = _leaf_pairs(leaves.select("grp", "leaf", "lo", "hi"), eps * eps)
    pairs = stage(pairs.withColumn("pair", F.monotonically_increasing_id()))
    sides = pairs.select("grp", "pair", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("leaf"))))
                                                 .otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("leaf")),
                                                                    F.struct(F.lit(1).alias("side"), F.col("b").alias("leaf"))))).alias("s"))
    sides = sides.select("grp", "pair", "s.side", "s.leaf")
    leafed = placed.join(leaves.select("grp", "stretch", "leaf"), ["grp", "stretch"]).join(classes.select("cls", "copies"), "cls")
    leafed = stage(leafed.select("grp", "leaf", "cls", "copies", "at", "embedding", "p"))
    work = sides.join(leafed, ["grp", "leaf"]).repartition("grp", "pair").sortWithinPartitions("grp", "pair")
    found = stage(work.mapInArrow(_joined(least), "cls long, other long, n long"))
    counts = found.filter("other < 0").groupBy("cls").agg(F.sum("n").alias("n"))
    edges = found.filter("other >= 0").select(F.col("cls").alias("a"), F.col("other").alias("b"))
    groups = components(edges)
    named = classes.join(counts, "cls", "left").join(groups, classes["cls"] == groups["node"], "left")
    named = stage(named.select(classes["cls"], "grp", classes["label"], "embedding", "id",
                               (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                               F.coalesce(groups["label"], classes["cls"]).alias("root")))
    smallest = named.groupBy("root").agg(F.min("id").alias("component"))
    named = stage(named.join(smallest, "root").select(F.col("grp").alias("_g"), F.col("label").alias("_l"), F.col("embedding").alias("_e"), "n_links", "component"))
    out = rows.join(named, (F.col("grp") == F.col("_g")) & (F.col("label") == F.col("_l")) & (F.col("embedding") == F.col("_e")) & F.col("good"), "left")
    real = lambda c: F.when(c != F.lit(-(2**63)), c)
    component = F.coalesce("component", "id")
    return out.select(real(F.col("id")).alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      real(component).alias("component_id"), (F.col("id") == component).alias("kept"))

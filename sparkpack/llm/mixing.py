"""Mixing sources to target weights: min-cost flow from membership patterns to source quotas, then a seeded choice."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpack.llm.common import running, seeded_hash, slots_for

SEED = 31
EPOCHS = 3
_TOP = 1 << 60


def targets(sizes: dict, weights: dict, budget: float | None = None, most: int = EPOCHS) -> dict:
    """Tokens wanted of each source: shares of the budget (all sizes by default) by weight, none above most times its size.

    What a capped source leaves is shared out again by weight until no source is above its cap.
    """
    left = float(sum(sizes.values())) if budget is None else float(budget)
    out: dict = {}
    open_ = sorted(sizes, key=lambda s: (most * sizes[s] / weights[s], str(s)))
    rest = sum(weights[s] for s in open_)
    for s in open_:
        out[s] = min(float(most * sizes[s]), left * weights[s] / rest)
        left, rest = left - out[s], rest - weights[s]
    return out


def route(capacity: dict[tuple, int], quota: dict, most: int = EPOCHS) -> dict[tuple, float]:
    """Min-cost flow: tokens that each pattern (tuple of sources) gives to each of its sources.

    A pattern offers its capacity once per epoch; epoch e costs e per token, so repeats are convex and used last. Paths of
    least cost are augmented one after another (Bellman-Ford over patterns and sources, a small graph: one
    node per pattern that occurs and per source). Returns {(pattern, source): tokens}.
    """
    patterns, sources = sorted(capacity, key=str), sorted(quota, key=str)
    sent = {(p, s): 0.0 for p in patterns for s in p if s in quota}
    need, eps = dict(quota), 1e-6
    used = {p: 0.0 for p in patterns}
    while True:
        # distances from the open quotas back over sources and patterns to unused capacity
        dist, via = {("s", s): 0.0 for s in sources if need[s] > eps}, {}
        for _ in range(len(patterns) + len(sources) + 1):
            changed = False
            for p, s in sent:
                d = dist.get(("s", s))
                if d is not None and d < dist.get(("p", p), 1e300) - 1e-12:
                    dist[("p", p)], via[("p", p)], changed = d, ("s", s), True
                d = dist.get(("p", p))
                if sent[p, s] > eps and d is not None and d < dist.get(("s", s), 1e300) - 1e-12:
                    dist[("s", s)], via[("s", s)], changed = d, ("p", p), True
            if not changed:
                break
        best = None
        for p in patterns:
            epoch = int(used[p] / capacity[p] + 1e-9) if capacity[p] else most
            if epoch < most and ("p", p) in dist:
                cost = dist[("p", p)] + epoch
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, p, capacity[p] * (epoch + 1) - used[p])
        if best is None:
            return sent
        node, amount, path = ("p", best[1]), best[2], []
        while node in via:
            path.append((node, via[node]))
            node = via[node]
        amount = min(amount, need[node[1]])
        for x, y in path:
            if x[0] == "s":
                amount = min(amount, sent[y[1], x[1]])
        for x, y in path:
            if x[0] == "p":
                sent[x[1], y[1]] += amount
            else:
                sent[y[1], x[1]] -= amount
        used[best[1]] += amount
        need[node[1]] -= amount


def mix_sources(docs: DataFrame, key: str, size: Column, members: Column, weights, seed: int = SEED, most: int = EPOCHS) -> DataFrame:
    """Add size, and copies: how often the mix takes the document.

    members: the array of sources a document belongs to (the null source as a null element). weights: function from
    the source list, ordered by code point with null last, to their weights. Documents are summed by membership
    pattern; the min-cost flow gives each pattern its tokens; whole epochs are taken of every document of the
    pattern, and the rest from a seeded order of its documents up to the one nearest the wanted amount.
    A document is taken `most` times at most. Only the sums per pattern reach the driver: as many rows as
    source combinations occur. Null keys hash as such; an empty table gives an empty table; documents of
    size 0 have copies 1 if their pattern is used at all. Rows must not hold large columns.
    """
    base = docs.withColumn("size", size.cast("long")).withColumn("_pattern", F.array_sort(F.array_distinct(members)))
    sums = base.groupBy("_pattern").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    capacity = {tuple(r["_pattern"]): int(r["s"]) for r in sums}
    names = sorted({s for p in capacity for s in p if s is not None}) + ([None] if any(None in p for p in capacity) else [])
    total = {s: sum(c for p, c in capacity.items() if s in p) for s in names}
    weight = dict(zip(names, weights(names)))
    want = targets(total, weight, float(sum(capacity.values())), most) if names else {}
    sent = route(capacity, want, most)
    plan = []
    for p, c in capacity.items():
        tokens = sum(v for (q, _), v in sent.items() if q == p)
        full = min(most, int(tokens / c + 1e-9)) if c else 1
        plan.append((list(p), full, 0 if full == most or not c else int(round(tokens - full * c))))
    spark = docs.sparkSession
    kind = base.schema["_pattern"].dataType.simpleString()
    quota = spark.createDataFrame(plan, f"_p {kind}, _full int, _more long")
    slots = slots_for(sum(r["n"] for r in sums))
    h = seeded_hash(seed, F.col(key))
    base = base.withColumn("_h", h)
    slot = F.least(F.floor(F.col("_h") / F.lit(float(_TOP)) * slots), F.lit(slots - 1))
    order = [F.col("_h"), F.col(key), F.col("size")]
    run = running(base, ["_pattern"], slot, order, F.col("size"), slots, "_before")
    # the document whose middle the bound passes is in or out, whichever ends nearer
    extra = F.when((F.col("_more") > 0) & (2 * F.col("_before") + F.col("size") <= 2 * F.col("_more")), 1).otherwise(0)
    out = run.join(F.broadcast(quota), run["_pattern"].eqNullSafe(quota["_p"]))
    out = out.withColumn("copies", (F.col("_full") + extra).cast("int"))
    return out.drop("_pattern", "_p", "_full", "_more", "_h", "_before")


def source_targets(docs: DataFrame, size: str, source: str, weights, most: int = EPOCHS) -> DataFrame:
    """Per source: source_size and target, as `mix_sources` aims at them where every document has one source."""
    sums = docs.groupBy(F.col(source).alias("_source")).agg(F.sum(size).alias("source_size")).collect()
    sizes = {r["_source"]: int(r["source_size"]) for r in sums}
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    want = targets(sizes, dict(zip(names, weights(names))), most=most) if names else {}
    rows = [(s, sizes[s], float(want[s])) for s in names]
    return docs.sparkSession.createDataFrame(rows, "_source string, source_size long, target double")


def cycling_weights(names: list) -> list[int]:
    """1, 2, 3, repeating over the sources in code point order, null last."""
    return [1 + i % 3 for i in range(len(names))]

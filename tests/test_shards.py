"""Lookups in maps of many shards, unevenly spread, and of many versions."""
import bisect
import random

import pytest
from pyspark.sql import functions as F

from sparkpack.operators import shards

TOP = 2**128 - 1


def made(rng, n, spread):
    """End keys: half of them spread evenly, half within a narrow stretch."""
    near = rng.randrange(TOP - spread)
    ends = {rng.randrange(TOP) for _ in range(n // 2)} | {near + rng.randrange(spread) for _ in range(n // 2)} | {TOP}
    return sorted(ends), near


@pytest.mark.parametrize("n, spread", [(10, 10**30), (3000, 10**12), (100_000, 10**20)])
def test_index_finds_what_a_search_finds(spark, n, spread):
    rng = random.Random(n)
    ends, near = made(rng, n, spread)
    keys = [rng.randrange(TOP) for _ in range(1500)] + [near + rng.randrange(spread) for _ in range(1500)] + rng.sample(ends, min(500, n)) + [0, TOP]
    ranges = shards.shard_ranges(spark.createDataFrame([(i, f"{e:039}") for i, e in enumerate(ends)], "shard_no long, end_key string"))
    index = shards.shard_index(ranges)
    per_cell = index.cells.groupBy("_cell").count().agg(F.max("count")).first()[0]
    assert per_cell <= shards.CELL_SHARDS and index.cells.count() <= 15 * len(ends) + 400 + 1000 * sum(d.count() for _, d in index.splits)
    df = spark.createDataFrame([(i, f"{k:039}") for i, k in enumerate(keys)], "id long, hash_key string")
    got = {r.id: r.shard_no for r in shards.shard_lookup_index(df, index).collect()}
    assert got == {i: bisect.bisect_left(ends, k) for i, k in enumerate(keys)}


def test_index_of_several_maps_and_of_none(spark):
    rng = random.Random(1)
    maps = {f"m{i}": made(rng, size, 10**9)[0][:-1] for i, size in enumerate((4, 200, 900))}     # no map reaches the top
    rows = [(m, i, f"{e:039}") for m, ends in maps.items() for i, e in enumerate(ends)]
    ranges = shards.shard_ranges(spark.createDataFrame(rows, "m string, shard_no long, end_key string"), ["m"])
    keys = [(m, rng.choice([rng.randrange(TOP), rng.choice(ends), TOP])) for m, ends in maps.items() for _ in range(300)] + [("other", 5), (None, 5)]
    df = spark.createDataFrame([(i, m, f"{k:039}") for i, (m, k) in enumerate(keys)], "id long, m string, hash_key string")
    got = {r.id: r.shard_no for r in shards.shard_lookup_index(df, shards.shard_index(ranges, ["m"])).collect()}
    place = lambda m, k: bisect.bisect_left(maps.get(m, []), k)
    assert got == {i: place(m, k) if place(m, k) < len(maps.get(m, [])) else -1 for i, (m, k) in enumerate(keys)}
    assert {r.shard_no for r in shards.shard_lookup_index(df, shards.shard_index(ranges.limit(0), ["m"])).collect()} == {-1}


def test_asof_with_many_versions(spark):
    rng = random.Random(2)
    times = sorted(rng.sample(range(100, 9000), 60))
    rows = [(t, 100 * v + i, f"{e:039}") for v, t in enumerate(times) for i, e in enumerate([TOP // 3 + v, TOP // 2 + v, TOP])]
    versions = spark.createDataFrame(rows, "t long, shard_no long, end_key string").select(F.timestamp_seconds("t").alias("valid_from"), "shard_no", "end_key")
    puts = [(i, rng.choice([rng.randrange(10_000), rng.choice(times)]), rng.choice([rng.randrange(TOP), TOP // 3 + rng.randrange(60)])) for i in range(800)]
    df = spark.createDataFrame([(i, t, f"{k:039}") for i, t, k in puts], "id long, t long, hash_key string").withColumn("arrival_ts", F.timestamp_seconds("t"))
    got = {r.id: r.shard_no for r in shards.shard_lookup_asof(df, versions, 1000_000).collect()}
    for i, t, k in puts:
        v = bisect.bisect_right(times, t) - 1
        want = -1 if v < 0 else 100 * v + bisect.bisect_left([TOP // 3 + v, TOP // 2 + v, TOP], k)
        assert got[i] == want

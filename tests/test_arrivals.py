"""Buffers filled by arrival, flushed by deadline, against a record-by-record version."""
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from sparkpack.operators.arrivals import fold_arrivals
from sparkpack.operators.fold import BatchRule

RULES = [
    BatchRule(size_limit=300, count_limit=9, packed=True),
    BatchRule(size_limit=200, count_limit=12, margin=10),
    BatchRule(count_limit=5),
    BatchRule(),
    BatchRule(size_limit=900, count_limit=40, burst_limit=120),
]


def made(seed, n=700, keys=3):
    rng = random.Random(seed)
    out, clock = [], 0
    for i in range(n):
        clock += rng.choice([0, 1, 2, 5, 200 if rng.random() < 0.03 else 1])
        out.append({"id": i, "key": "hot" if rng.random() < 0.6 else f"k{rng.randrange(keys)}", "size": rng.choice([0, 3, 20, 60, 400 if rng.random() < 0.02 else 5]),
                    "arrival": clock, "deadline": clock + rng.choice([-3, 0, 4, 15, 40, 120]), "flag": rng.random() < 0.02,
                    "pk": rng.choice(["a", "bb", "ccc", "é", " "]), "ehk": rng.choice([None, None, "1", "77"]), "burst": rng.randrange(3)})
    return out


@pytest.mark.parametrize("rule", RULES, ids=lambda r: f"size={r.size_limit},count={r.count_limit},packed={r.packed},burst={r.burst_limit}")
@pytest.mark.parametrize("block_rows", [7, 100_000])
def test_fold_equals_record_by_record(spark, rule, block_rows):
    rows = made(block_rows + rule.count_limit % 1000)
    us = F.timestamp_micros
    df = spark.createDataFrame([(r["key"], r["id"], r["size"], r["arrival"], r["deadline"], r["flag"], r["pk"], r["ehk"], r["burst"]) for r in rows],
                               "k string, source_id long, size long, a long, d long, flag boolean, partition_key string, explicit_hash_key string, burst long")
    df = df.withColumns({"arrival_ts": us(F.col("a")), "deadline_ts": us(F.col("d"))}).repartition(3)
    got = defaultdict(list)
    for r in fold_arrivals(df, rule, size=F.col("size"), keys=["k"], slice_ms=1, flag=F.col("flag"),
                           burst_key=F.col("burst"), block_rows=block_rows).collect():
        got[r.k].append(r)
    arrival = {r["id"]: r["arrival"] for r in rows}
    for key in {r["key"] for r in rows}:
        want, cuts = brute.arrival_batches([r for r in rows if r["key"] == key], rule)
        found = defaultdict(dict)
        for r in got.pop(key):
            found[r.batch_id, r.flush_us, r.reason][r.pos] = r.id
            assert r.cuts == cuts.get(r.id, 0) and r.flush_us >= arrival[r.id]
        assert {k: [v[i] for i in range(len(v))] for k, v in found.items()} == {(ids[0], when, why): ids for ids, when, why in want}
    assert not got


def test_nothing_arrives(spark):
    df = spark.createDataFrame([], "k string, source_id long, size long, arrival_ts timestamp, deadline_ts timestamp")
    assert fold_arrivals(df, RULES[1], size=F.col("size"), keys=["k"], slice_ms=1000).collect() == []

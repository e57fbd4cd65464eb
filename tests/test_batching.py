import random

import pytest
from pyspark.sql import functions as F

import brute
from sparkpack.operators import batching as B
from sparkpack.operators.fold import BatchRule

SCHEMA = ("stream_name string, shard_no long, source_id long, size long, arrival long, deadline long, flag boolean, "
          "partition_key string, explicit_hash_key string, burst long")
BUFFERED_MS = 20


def make(n, seed, giants=True):
    """One hot key with nearly all records, one small key; bursts, pauses, giants, repeated and explicit keys."""
    rnd, now, rows = random.Random(seed), 1_000_000, []
    for i in range(n):
        now += rnd.choice([0, 500, 1_000, 3_000, 60_000 if rnd.random() < 0.05 else 800])
        size = rnd.choice([1, 5, 9, 40, 130, 700 if giants and rnd.random() < 0.3 else 20])
        key = f"k{rnd.randrange(30)}" if rnd.random() < 0.9 else " "
        ehk = str(10**30 + rnd.randrange(4)) if rnd.random() < 0.3 else None
        rows.append(("hot" if rnd.random() < 0.95 else "cold", rnd.randrange(1), i, size, now, now + BUFFERED_MS * 1000,
                     rnd.random() < 0.02, key, ehk, rnd.choice([-1, 1, 2])))
    return rows


RULES = {
    "packed": BatchRule(size_limit=400, count_limit=9, packed=True),
    "packed wide": BatchRule(size_limit=3000, packed=True, use_deadline=False),
    "sum": BatchRule(size_limit=300),
    "sum no timers": BatchRule(size_limit=300, margin=0, use_deadline=False),
    "count": BatchRule(size_limit=10**6, count_limit=7),
    "deadline": BatchRule(),
    "burst": BatchRule(size_limit=2000, count_limit=50, burst_limit=200),
}


@pytest.mark.parametrize("name, chain", [(n, None) for n in RULES] + [("packed", 3), ("sum no timers", 5), ("deadline", 2)])
def test_fold_equals_record_by_record(spark, monkeypatch, name, chain):
    if chain:                                       # few blocks a task: several levels of groups
        monkeypatch.setattr(B, "CHAIN", chain)
    rule, rows = RULES[name], make(1500 if not chain else 500, 7)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({
        "arrival_ts": F.timestamp_micros("arrival"), "deadline_ts": F.timestamp_micros("deadline")})
    got = B.fold_batches(
        df, rule, size=F.col("size"), flag=F.col("flag"), burst_key=F.col("burst"),
        slice_ms=50, block_cost=1, block_ms=1, buffered_ms=BUFFERED_MS).collect()       # smallest blocks: many boundaries
    assert len(got) == len(rows) and len({r.id for r in got}) == len(rows)
    found = {}
    for r in sorted(got, key=lambda r: (r.stream_name, r.rn)):
        found.setdefault((r.stream_name, r.shard_no, r.batch_rn), ([], r.flush_us, r.reason))[0].append(r.id)
    expected = []
    for stream in ("hot", "cold"):
        records = [dict(zip(("id", "size", "arrival", "deadline", "flag", "pk", "ehk", "burst"), r[2:])) for r in rows if r[0] == stream]
        expected += brute.batches(sorted(records, key=lambda r: (r["deadline"], r["arrival"], r["id"])), rule)
    assert sorted(found.values()) == sorted(expected)


def test_blocks_were_really_cut(spark):
    rows = make(400, 3)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({
        "arrival_ts": F.timestamp_micros("arrival"), "deadline_ts": F.timestamp_micros("deadline")})
    rule = RULES["packed"]
    cut, _, _ = B._blocks(df, B.KEYS, B.ORDER, rule, F.col("size"), None, None, 50, 1, 1, BUFFERED_MS, "source_id")
    assert cut.filter("stream_name = 'hot'").select("_block").distinct().count() > 5


def test_counts_and_predicates(spark):
    rows = make(700, 5)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({
        "arrival_ts": F.timestamp_micros("arrival"), "deadline_ts": F.timestamp_micros("deadline")})
    order = lambda rs: sorted(rs, key=lambda r: (r[5], r[4], r[2]))
    by_count = {r.source_id: (r.batch_no, r.pos) for r in B.batch_by_count(df, 10, 50).collect()}
    by_flag = {r.source_id: r.batch_no for r in B.batch_predicate(df, F.col("flag"), 50).collect()}
    islands = {r.source_id: r.island for r in B.batch_islands(df, 30).collect()}
    for stream in ("hot", "cold"):
        batch = island = 0
        previous = None
        for i, r in enumerate(order([r for r in rows if r[0] == stream])):
            assert by_count[r[2]] == (i // 10, i % 10)
            assert by_flag[r[2]] == batch
            batch += r[6]
            island += previous is not None and r[4] - previous > 30_000
            assert islands[r[2]] == island
            previous = r[4]


def test_flush_commands(spark):
    rows = make(300, 9)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({
        "arrival_ts": F.timestamp_micros("arrival"), "deadline_ts": F.timestamp_micros("deadline")})
    marks = [("hot", 1_050_000), (None, 1_200_000), ("cold", 1_300_000), ("nobody", 1_300_000)]
    controls = spark.createDataFrame(marks, "stream_name string, at long").select("stream_name", F.timestamp_micros("at").alias("flush_ts"))
    got = {r.source_id: r.flush_no for r in B.flush_all(df, controls).collect()}
    assert got == {r[2]: sum(at <= r[4] for s, at in marks if s in (None, r[0])) for r in rows}

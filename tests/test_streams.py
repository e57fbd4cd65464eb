"""Several micro-batches give what the batch operators give."""
import time

import pytest
from pyspark.sql import functions as F

from sparkpack.functions import metric_names as M
from sparkpack.operators import metrics as MT
from sparkpack.operators import shards

from sparkpack.operators.stage import new_path
from sparkpack.plans import packing_queries as P
from sparkpack.sources import fixtures as fx
from sparkpack.streaming import outcomes, processors, statistics
from sparkpack.streaming.routing import MapInUse, route_with_feedback
from sparkpack.streaming.runner import run_and_close, run_each_batch, run_to_table, stream_session


def parts(spark, d, n=3, order=None):
    """The event table as n files of consecutive times, written in the given order; one file per micro-batch."""
    path = new_path(spark, "events")
    ev = fx.events(spark, d)
    size = ev.count() // n + 1
    for i in order or range(n):
        ev.filter(F.expr(f"event_id div {size}") == i).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)                                     # the file source orders files by time of change
    s = stream_session(spark)
    return s, s.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)


def packed(spark, data_dir, order):
    _, events = parts(spark, data_dir, order=order)
    return run_and_close(events.sparkSession, lambda ticks: processors.stream_pack(
        fx.routed(fx.records_from_events(events)), P.full_rule(fx.SCALED), ticks=ticks), "2100-01-02").collect()


def test_packing_over_micro_batches(spark, data_dir):
    got = packed(spark, data_dir, [0, 1, 2])
    want = {r.id: (r.batch_rn, r.flush_us, r.reason) for r in P.full_batches(fx.routed_records(spark, data_dir)).collect()}
    assert len(got) == len(want)
    assert {r.id: (r.batch_rn, r.flush_us) for r in got} == {i: v[:2] for i, v in want.items()}


def test_packing_loses_no_late_record(spark, data_dir):
    """Newest file first: every record leaves once, in batches within the limits."""
    rows = packed(spark, data_dir, [2, 0, 1])
    ids = [r.source_id for r in fx.routed_records(spark, data_dir).select("source_id").collect()]
    assert sorted(r.id for r in rows) == sorted(ids)
    assert max(r.pos for r in rows) < P.full_rule(fx.SCALED).count_limit


def test_rate_limit_over_micro_batches(spark, data_dir):
    stream = fx.routed(fx.records_from_events(parts(spark, data_dir)[1]))
    got = {r.source_id: r for r in run_to_table(processors.stream_rate_limit(stream, P.SLOW_RECORDS, P.BYTES)).collect()}
    from sparkpack.operators import shaping as S
    want = S.rate_limit_expired(fx.routed_records(spark, data_dir), P.SLOW_RECORDS, P.BYTES, P.payload_size(), fx.SCALED.slice_ms).collect()
    assert len(got) == len(want)
    for r in want:
        assert got[r.source_id].expired == r.expired and (r.expired or abs(got[r.source_id].send_s - r.send_s) < 1e-4)


def closed(events, build):
    return run_and_close(events.sparkSession, build, "2100-01-02")


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0]])
def test_statistics_count_every_sample(spark, data_dir, order):
    _, events = parts(spark, data_dir, order=order)
    got = closed(events, lambda ticks: statistics.stream_buckets(
        fx.samples_from_events(events), M.dims_text(F.col("dims")), 1, salts=2, ticks=ticks)).cache()
    merged = {(r.dims, r.bucket): (r["count"], round(r["sum"], 6), r["min"], r["max"]) for r in got.groupBy("dims", "bucket").agg(*MT.merge_stats()).collect()}
    want = fx.metric_samples(spark, data_dir).groupBy(M.dims_text(F.col("dims")).alias("dims"), MT.second_of(F.col("ts")).alias("bucket")).agg(*MT.sample_stats(F.col("value")))
    assert merged == {(r.dims, r.bucket): (r["count"], round(r["sum"], 6), r["min"], r["max"]) for r in want.collect()}
    assert (got.filter("correction").count() > 0) == (order[0] != 0)         # only files out of order bring late samples


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0]])
def test_every_put_has_one_outcome(spark, data_dir, order):
    _, events = parts(spark, data_dir, order=order)
    got = closed(events, lambda ticks: outcomes.stream_outcomes(
        fx.records_from_events(events), fx.results_from_events(events), 500, ticks=ticks)).collect()
    done = {}
    for r in fx.results(spark, data_dir).collect():
        done.setdefault(r.source_id, []).append((r.finished_ts, r.success))
    want = {}
    for r in fx.user_records(spark, data_dir).collect():
        fits = [ok for at, ok in sorted(done.pop(r.source_id, [])) if 0 <= (at - r.arrival_ts).total_seconds() <= 0.5]
        want[r.source_id] = "Expired" if not fits else "delivered" if fits[0] else "failed"
    want.update(dict.fromkeys(done, "orphan"))
    assert len(got) == len(want) and {r.source_id: r.outcome for r in got} == want


def test_results_before_their_puts(spark):
    """Results in the first file, puts in the second, a result past the limit, and one for nobody."""
    path = new_path(spark, "mixed")
    rows = [[("result", 1, True, 100.2), ("result", 2, False, 200.1), ("result", 3, True, 309.0), ("result", 9, True, 50.0)],
            [("put", 1, None, 100.0), ("put", 2, None, 200.0), ("put", 3, None, 300.0), ("put", 4, None, 20.0), ("put", 1, None, 100.0)],
            [("result", 1, False, 100.1), ("put", 5, None, 7000.0), ("result", 4, True, 20.1)]]
    for part in rows:
        df = spark.createDataFrame(part, "kind string, source_id long, success boolean, s double").withColumn("ts", F.timestamp_seconds("s"))
        df.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    s = stream_session(spark)
    every = s.readStream.schema("kind string, source_id long, success boolean, s double, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    puts = every.filter("kind = 'put'").select("source_id", F.col("ts").alias("arrival_ts"))
    results = every.filter("kind = 'result'").select("source_id", "success", F.col("ts").alias("finished_ts"))
    got = run_and_close(s, lambda ticks: outcomes.stream_outcomes(puts, results, 500, "10 minutes", ticks=ticks), "2100-01-02").collect()
    assert sorted((r.source_id, r.outcome) for r in got) == [(1, "delivered"), (2, "failed"), (3, "Expired"), (4, "delivered"), (5, "Expired"), (9, "orphan")]


@pytest.mark.parametrize("order", [[2, 1, 0]])
def test_each_record_finishes_once_in_any_order(spark, data_dir, order):
    _, events = parts(spark, data_dir, order=order)
    got = run_to_table(outcomes.finish_once(fx.results_from_events(events), 86_400_000), idle=False).collect()
    ids = {r.source_id for r in fx.results(spark, data_dir).select("source_id").collect()}
    assert sorted(r.source_id for r in got) == sorted(ids)


def test_a_silent_key_flushes_at_its_deadline(spark):
    """Key 1 falls silent; rows of key 2 move the clock, and key 1 leaves in the second micro-batch, long before the end."""
    path = new_path(spark, "puts")
    for part in ([(1, 1, 0), (2, 1, 10), (3, 2, 20)], [(4, 2, 1000)], [(5, 1, 1005), (6, 1, 30)]):
        df = spark.createDataFrame(part, "source_id long, shard_no long, s long").select(
            F.lit("st").alias("stream_name"), "shard_no", "source_id", F.timestamp_seconds("s").alias("arrival_ts"),
            F.timestamp_seconds(F.col("s") + 100).alias("deadline_ts"), F.lit("k").alias("partition_key"),
            F.lit(None).cast("string").alias("explicit_hash_key"), F.lit("data").cast("binary").alias("data"))
        df.coalesce(1).write.mode("append").parquet(path)
        schema = df.schema
        time.sleep(1.1)
    s = stream_session(spark)
    puts = s.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    # no closing tick: what is here left by timers alone
    rows = {r.id: r for r in run_to_table(processors.stream_pack(puts, P.full_rule(fx.SCALED))).collect()}
    assert {1, 2, 3} <= set(rows)
    assert rows[1].flush_us == rows[2].flush_us == 100_000_000 and rows[3].flush_us == 120_000_000
    assert rows[1].batch_rn == rows[2].batch_rn == 1 and rows[1].reason == "deadline" and not rows[1].late
    rows = {r.id: r for r in run_and_close(s, lambda ticks: processors.stream_pack(puts, P.full_rule(fx.SCALED), ticks=ticks), "2100-01-02").collect()}
    assert set(rows) == {1, 2, 3, 4, 5, 6}
    assert rows[6].late and not rows[5].late and rows[6].flush_us >= 1000_000_000


def test_a_wrong_shard_renews_the_map(spark, data_dir):
    """Shard 2 closes after the first micro-batch: the second is still routed by the old map, its results show it, and no record of
    the third goes to the closed shard."""
    _, events = parts(spark, data_dir)
    before = {2: fx.THREE_SHARDS[0][1], 3: fx.THREE_SHARDS[1][1], 1: fx.THREE_SHARDS[2][1]}
    after = {4: "042535295865117307932921825928971026431", 5: before[2], 3: before[3], 1: before[1]}
    state = {"batches": 0}

    def service(session):
        ends = before if state["batches"] < 1 else after
        names = fx.events(session, data_dir).select(F.col("event_type").alias("stream_name")).distinct()
        return names.crossJoin(F.broadcast(fx.values(session, list(ends.items()), "shard_no, end_key").withColumn("shard_no", F.col("shard_no").cast("bigint"))))

    maps = MapInUse(service)

    def stored(routed):
        now = shards.shard_lookup(routed.drop("shard_no"), shards.shard_ranges(service(routed.sparkSession), ["stream_name"]), on=["stream_name"])
        return routed.select("source_id", F.col("shard_no").alias("predicted_shard")).join(now.select("source_id", F.col("shard_no").alias("stored_shard")), "source_id")

    step, sent = route_with_feedback(maps, stored), []

    def route(batch):
        out = step(fx.keyed(batch))
        sent.append({r.shard_no for r in out.select("shard_no").distinct().collect()})
        state["batches"] += 1
        return out.select("source_id", "shard_no")

    got = run_each_batch(fx.records_from_events(events), route, "source_id long, shard_no long")
    assert got.count() == fx.events(spark, data_dir).count()
    assert sent[0] == {1, 2, 3} and 2 in sent[1] and sent[2] == {1, 3, 4, 5} and maps.reads == 2

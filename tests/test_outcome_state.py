"""State of the outcome streams: many records per call, the same outcome as record by record."""
import random
import time

import numpy as np
from pyspark.sql import functions as F

from sparkpack.operators.stage import new_path
from sparkpack.streaming import outcomes
from sparkpack.streaming.runner import run_and_close, run_to_table, stream_session


def state_rows(spark, df, idle=True):
    """Rows in the state store after the stream's input has been read."""
    s = df.sparkSession
    s.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle).lower())
    q = (df.writeStream.format("parquet").outputMode("append").option("path", new_path(spark, "sink"))
         .option("checkpointLocation", new_path(spark, "state")).trigger(availableNow=True).start())
    q.awaitTermination()
    return max(op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"])


def numbered(spark, n):
    path = new_path(spark, "rows")
    spark.range(n).select(F.col("id").alias("source_id"), F.lit(True).alias("success"), F.timestamp_seconds(F.lit(100)).alias("finished_ts"),
                          F.timestamp_seconds(F.lit(100)).alias("arrival_ts")).coalesce(1).write.parquet(path)
    s = stream_session(spark)
    return s.readStream.schema("source_id long, success boolean, finished_ts timestamp, arrival_ts timestamp").parquet(path)


def test_outcomes_keep_state_per_bucket(spark):
    rows = numbered(spark, 5000)
    assert state_rows(spark, outcomes.stream_outcomes(rows, rows, 500)) < 5000


def reference(batches, ttl, keep):
    """Record by record; batches are (clock in ms, rows (id, what, at, ok))."""
    state, out = {}, []
    for now, rows in batches:
        per = {}
        for r in rows:
            per.setdefault(r[0], []).append(r)
        for i, new in per.items():
            st = state.setdefault(i, {"put": None, "results": [], "done": False, "wake": None})
            if st["done"]:
                continue
            for _, what, at, ok in new:
                if what == outcomes.PUT:
                    st["put"] = at if st["put"] is None else min(at, st["put"])
                else:
                    st["results"].append((at, not ok))
            fits = sorted(r for r in st["results"] if st["put"] is not None and st["put"] <= r[0] <= st["put"] + ttl)
            if fits:
                out.append((i, "failed" if fits[0][1] else "delivered", fits[0][0]))
                st.update(done=True, wake=max(now, -(-fits[0][0] // 1000)) + keep)
            elif st["put"] is not None:
                st["wake"] = max(now, (st["put"] + ttl) // 1000) + 1
            else:
                st["wake"] = max(now, -(-max(r[0] for r in st["results"]) // 1000)) + keep
        for i, st in list(state.items()):
            if st["wake"] >= now:
                continue
            if st["done"]:
                del state[i]
            elif st["put"] is not None:
                out.append((i, "Expired", st["put"] + ttl))
                st.update(done=True, wake=max(now, -(-(st["put"] + ttl) // 1000)) + keep)
            else:
                out.append((i, "orphan", min(r[0] for r in st["results"])))
                del state[i]
    return out


def test_a_bucket_decides_as_its_records_would_alone():
    rng = random.Random(7)
    for _ in range(60):
        ttl, keep, now, batches = 5_000, 20, 0, []
        for _ in range(12):
            now += rng.choice([0, 1, 7, 30])
            batches.append((now, [(rng.randrange(8), rng.choice([outcomes.PUT, outcomes.RESULT]), 1000 * now + rng.randrange(-9000, 9000), rng.random() < 0.6)
                                  for _ in range(rng.randrange(6))]))
        batches.append((10**6, []))
        state, got = np.zeros(0, outcomes.STATE), []
        for now, rows in batches:
            new = np.zeros(len(rows), outcomes.STATE)
            for i, r in enumerate(rows):
                new[i] = (*r, 0)
            for step in (lambda s: outcomes.settle(s, new, ttl, keep, now), lambda s: outcomes.expire(s, ttl, keep, now)):
                state, out = step(state)
                got += out
        assert sorted(got) == sorted(reference(batches, ttl, keep))


def test_rows_without_a_time(spark):
    path = new_path(spark, "mixed")
    rows = [("put", 1, None, None), ("put", 2, None, 5.0), ("result", 2, True, None), ("result", 3, True, None)]
    df = spark.createDataFrame(rows, "kind string, source_id long, success boolean, s double").withColumn("ts", F.timestamp_seconds("s"))
    df.coalesce(1).write.parquet(path)
    s = stream_session(spark)
    every = s.readStream.schema(df.schema).parquet(path)
    puts = every.filter("kind = 'put'").select("source_id", F.col("ts").alias("arrival_ts"))
    results = every.filter("kind = 'result'").select("source_id", "success", F.col("ts").alias("finished_ts"))
    got = run_and_close(s, lambda ticks: outcomes.stream_outcomes(puts, results, 500, ticks=ticks, buckets=2), "2100-01-02").collect()
    assert sorted((r.source_id, r.outcome, r.at_us) for r in got) == [(1, "Expired", None), (2, "Expired", 5_500_000), (3, "orphan", None)]


def test_finishes_keep_state_per_bucket(spark):
    rows = numbered(spark, 5000)
    assert state_rows(spark, outcomes.finish_once(rows, 86_400_000), idle=False) < 5000


def test_the_first_to_finish_of_a_micro_batch_leaves(spark):
    path = new_path(spark, "results")
    for part in ([(1, True, 9.0), (1, False, 8.0), (2, False, None), (2, True, 7.0), (2, False, 7.0)], [(1, True, 1.0), (3, True, None)]):
        df = spark.createDataFrame(part, "source_id long, success boolean, s double").withColumn("finished_ts", F.timestamp_seconds("s"))
        df.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    s = stream_session(spark)
    results = s.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = run_to_table(outcomes.finish_once(results, 86_400_000, buckets=2), idle=False).collect()
    assert sorted(tuple(r) for r in got) == [(1, False, 8_000_000), (2, True, 7_000_000), (3, True, None)]

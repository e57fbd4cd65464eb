import datetime as dt

from pyspark.sql import functions as F

from sparkpack.config import PackConfig
from sparkpack.functions import metric_names as M
from sparkpack.operators import logs as L
from sparkpack.operators import metrics as MT
from sparkpack.operators import outcomes as O
from sparkpack.operators import scan
from sparkpack.sources import scans

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
THROTTLED = "ProvisionedThroughputExceededException"


def ms(n):
    return T0 + dt.timedelta(milliseconds=n)


def delivered(spark, codes, status=200, transport=False, fail_if_throttled=False, predicted=1, members=2, drop=0):
    """Outcome codes of one request whose entries answered with `codes` (None = stored in shard 1)."""
    n = len(codes)
    requests = spark.createDataFrame([(1, n, transport, status, "boom" if transport else None, ms(0), ms(5))],
                                     "request_id long, n_entries long, transport_error boolean, status int, error_text string, start_ts timestamp, end_ts timestamp")
    entries = spark.createDataFrame([(1, i, predicted) for i in range(n)], "request_id long, pos long, predicted_shard long")
    answers = [(1, i, "9" if c is None else None, "shardId-000000000001" if c is None else None, c, "m" if c else None)
               for i, c in enumerate(codes) if status == 200 and not transport and i < n - drop]
    responses = spark.createDataFrame(answers, "request_id long, pos long, sequence_number string, shard_id string, error_code string, error_message string")
    people = spark.createDataFrame([(1, i, i * 10 + k) for i in range(n) for k in range(members)], "request_id long, pos long, source_id long")
    out = O.entry_outcomes(O.match_results(entries, requests, responses), PackConfig(fail_if_throttled=fail_if_throttled))
    return {r.source_id: (r.outcome, r.code) for r in O.record_outcome(out, people).collect()}


def test_partial_failure(spark):
    codes = [None, None, "xx", "InternalFailure", "ServiceUnavailable", THROTTLED]
    got = delivered(spark, codes)
    want = ["success", "success", "fail", "retry", "retry", "retry"]
    assert got == {i * 10 + k: (w, codes[i]) for i, w in enumerate(want) for k in range(2)}
    assert delivered(spark, [THROTTLED], fail_if_throttled=True)[0] == ("fail", THROTTLED)


def test_whole_request_outcomes(spark):
    assert set(delivered(spark, [None] * 3, transport=True, status=None).values()) == {("retry", "Transport")}
    assert set(delivered(spark, [None] * 3, status=503).values()) == {("retry", "Http503")}
    assert set(delivered(spark, [None] * 3, status=400).values()) == {("fail", "Http400")}
    assert set(delivered(spark, [None] * 3, drop=1).values()) == {("fail", "Record Count Mismatch")}
    assert set(delivered(spark, [None], predicted=2).values()) == {("retry", "Wrong Shard")}
    assert set(delivered(spark, [None], predicted=-1).values()) == {("success", None)}


def test_retry_deadlines(spark):
    rows = [(1, "retry", "x", "m", ms(1000)), (2, "retry", "x", "m", ms(30)), (3, "retry", "x", "m", ms(5)), (4, "success", None, None, ms(9))]
    df = spark.createDataFrame(rows, "source_id long, outcome string, code string, message string, expiration_ts timestamp")
    out = O.retry_set(df, PackConfig(record_max_buffered_ms=100), F.lit(ms(10))).select(
        "source_id", "outcome", "code", "cause_code", ((F.unix_micros("deadline_ts") - F.lit(int(T0.timestamp() * 1e6))) / 1000).alias("d"))
    got = {r.source_id: (r.outcome, r.code, r.cause_code, r.d) for r in out.collect()}
    assert got == {1: ("retry", "x", "x", 60.0), 2: ("retry", "x", "x", 30.0), 3: ("fail", "Expired", "x", None)}


def test_attempt_history(spark):
    rows = [(7, 1, ms(0), ms(0), ms(5), False, "code"), (7, 2, ms(0), ms(11), ms(18), False, "code2"), (8, 1, ms(0), ms(3), ms(4), True, None)]
    df = spark.createDataFrame(rows, "source_id long, attempt_no int, arrival_ts timestamp, start_ts timestamp, end_ts timestamp, success boolean, error_code string")
    df = df.withColumns({"error_message": F.lit(None).cast("string"), "shard_id": F.when(F.col("success"), "s"), "sequence_number": F.when(F.col("success"), "1")})
    timing = {(r.source_id, r.attempt_no): (r.delay_ms, r.duration_ms) for r in O.attempt_timing(df).collect()}
    assert timing == {(7, 1): (0.0, 5.0), (7, 2): (6.0, 7.0), (8, 1): (3.0, 1.0)}
    results = {r.source_id: (len(r.attempts), r.success, r.shard_id) for r in O.put_record_result(df).collect()}
    assert results == {7: (2, False, None), 8: (1, True, "s")}
    assert {r.source_id: r.error_code for r in O.final_attempt(df).collect()} == {7: "code2", 8: None}


def samples(spark):
    rows = [("UserRecordsPut", None, "s", 0, float(i), i) for i in range(1, 6)] + [("ErrorsByCode", "c", "s", None, 2.0, 0), ("Odd", None, None, None, -3.0, 2)]
    df = spark.createDataFrame(rows, "name string, error_code string, stream_name string, shard_no long, value double, at long")
    return df.select("value", F.timestamp_seconds("at").alias("ts"), M.metric_dimensions(
        F.col("name"), F.col("error_code"), F.col("stream_name"), F.col("shard_no")).alias("dims"))


def table(df):
    return {r.d: (r["count"], r["sum"], r["min"], r["max"]) for r in df.withColumn("d", M.dims_text(F.col("dims"))).collect()}


def test_rollup_windows_and_filters(spark):
    per_second = MT.metric_per_second(samples(spark))
    rolled = table(MT.metric_rollup(MT.metric_totals(samples(spark))))
    assert rolled["MetricName=UserRecordsPut,StreamName=s,ShardId=0"] == (5, 15.0, 1.0, 5.0) == rolled["MetricName=UserRecordsPut"]
    assert rolled["MetricName=ErrorsByCode,ErrorCode=c"] == (1, 2.0, 2.0, 2.0) and rolled["MetricName=Odd"] == (1, -3.0, -3.0, -3.0)
    trailing = table(MT.metric_trailing(per_second, 4, 2))
    assert trailing == {"MetricName=UserRecordsPut,StreamName=s,ShardId=0": (2, 7.0, 3.0, 4.0)}
    kept = table(MT.metric_filter(MT.metric_rollup(MT.metric_totals(samples(spark))), "Summary", "stream"))
    assert set(kept) == {"MetricName=UserRecordsPut", "MetricName=UserRecordsPut,StreamName=s", "MetricName=ErrorsByCode",
                         "MetricName=ErrorsByCode,ErrorCode=c", "MetricName=ErrorsByCode,ErrorCode=c,StreamName=s"}
    assert table(MT.metric_filter(MT.metric_totals(samples(spark)), "none", "shard")) == {}


def test_trailing_windows_cross_slices(spark):
    df = spark.createDataFrame([(i, 1, float(i)) for i in range(0, 400, 7)], "second long, count long, sum double").select(
        "second", "count", "sum", F.col("sum").alias("min"), F.col("sum").alias("max"), F.array(M.dimension("MetricName", F.lit("x"))).alias("dims"))
    got = {r.second: (r["count"], r["sum"], r["min"]) for r in MT.metric_trailing_each(df, 60, 100).collect()}
    for s in range(0, 400, 7):
        inside = [float(x) for x in range(0, 400, 7) if s - 60 < x <= s]
        assert got[s] == (len(inside), sum(inside), min(inside))


def test_upload_batches(spark):
    df = spark.range(95).select(F.array(M.dimension("MetricName", F.concat(F.lit("m"), F.col("id") % 9)), M.dimension("ShardId", F.col("id"))).alias("dims"))
    rows = MT.metric_batches(df, 20).collect()
    ordered = [r.dims_text for r in sorted(rows, key=lambda r: (r.batch_no, r.pos))]
    assert ordered == sorted(ordered) and [sum(r.batch_no == b for r in rows) for b in range(5)] == [20, 20, 20, 20, 15]


def frames(spark, lines):
    df = spark.createDataFrame([("StdOut", i, l) for i, l in enumerate(lines)], "source string, line_no long, line string")
    records = [(r.kind, r.level, r.text) for r in L.log_levels(L.log_frames(df)).orderBy("first_line").collect()]
    odd = sorted((r.line_no, r.kind) for r in L.log_anomalies(df).collect())
    return records, odd


def test_log_frames(spark):
    lines = ["loose", "++++", "warning: a", "b", "----", "----", "++++", "----", "++++", "lost", "++++", "fatal: x", "----", "plain", "++++", "tail"]
    records, odd = frames(spark, lines)
    assert records == [("loose", "info", "loose"), ("frame", "warn", " a\nb"), ("frame", "error", " x"), ("loose", "info", "plain"), ("open", "info", "tail")]
    assert odd == [(5, "no data"), (5, "no start"), (7, "no data"), (10, "data dropped")]
    records, odd = frames(spark, ["++++", "just text", "----"])
    assert records == [("frame", "warn", "!!Failed to extract level!! - just text")] and odd == []


def test_ordered_scan_on_one_hot_key(spark):
    df = spark.range(5000).select(F.lit("k").alias("k"), "id", (F.col("id") % 7).alias("v"))
    out = scan.ordered_scan(df, ["k"], F.floor(F.col("id") / 100).cast("bigint"), [F.col("id")], sums={"s": F.col("v")},
                            lags={"p": F.col("v")}, lasts={"l": F.when(F.col("id") % 250 == 3, F.col("id"))}, totals={"t": F.col("v")})
    total, last, previous = 0, None, None
    for r in out.orderBy("id").collect():
        total, last = total + r.v, r.id if r.id % 250 == 3 else last
        assert (r.s, r.p, r.l, r.t) == (total, previous, last, sum(i % 7 for i in range(5000)))
        previous = r.v


def test_scans(spark):
    body = '{"Records":[{"SequenceNumber":"1","ShardId":"shardId-000000000002"},{"ErrorCode":"c","ErrorMessage":"m"}]}'
    df = spark.createDataFrame([(1, body), (2, "{}")], "request_id long, body string")
    got = sorted(((r.request_id, r.pos, r.sequence_number, r.error_code) for r in scans.parse_put_response(df).collect()), key=str)
    assert got == [(1, 0, "1", None), (1, 1, None, "c"), (2, None, None, None)]
    stored = spark.createDataFrame([(s, str(n)) for s in (1, 2) for n in (9, 10, 11, 100)], "shard_no long, sequence_number string")
    assert [r.sequence_number for r in scans.read_after_sequence(stored, "9", 2, shard=1).collect()] == ["10", "11"]
    assert scans.read_after_sequence(stored, "9", 2).count() == 4

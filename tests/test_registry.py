"""Registered queries against their SQL on the smallest tables. SPARKPACK_ALL=1 runs every query."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from sparkpack.plans.queries import queries as plan_queries

QUICK = ["put_records_scan", "validate_records", "shard_lookup_by_stream", "match_results", "record_outcome", "retry_set", "union_retries", "aggregate_records",
         "deaggregate_records", "collect_requests", "rate_limit_shard", "metric_rollup", "pending_gauge", "log_levels", "delivery_report",
         "stream_flush", "stream_results_join", "stream_metrics_second", "stream_finish_once", "stream_pack", "batch_full", "shard_burst_flush",
         "unflushed_remainder", "delivery_rounds", "put_pipeline", "metric_batches"]
NAMES = sorted(plan_queries()) if os.environ.get("SPARKPACK_ALL") else QUICK


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return "null" if value is None else str(value)


def test_every_query_has_a_check():
    from sparkpack.plans import queries as plans

    assert set(plans.queries()) == set(plans.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, data_dir, name):
    df = entry.queries()[name](spark, data_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    con = duckdb.connect()
    for f in os.listdir(data_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data_dir}/{f}'")
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0

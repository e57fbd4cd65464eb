"""The whole put path keeps every valid record and its limits."""
from pyspark.sql import functions as F

from sparkpack.operators import intake, shards
from sparkpack.operators import shaping as S
from sparkpack.operators.stage import materialize
from sparkpack.plans import delivery as D
from sparkpack.sources import fixtures as fx


def test_put_path_conserves_records_and_limits(spark, data_dir):
    cfg = D.PUT_CONFIG
    rows = D.put_pipeline(spark, data_dir).collect()
    valid = intake.validate_records(fx.dirty_records(spark, data_dir)).filter("reject_reason IS NULL").count()
    assert sum(r.records for r in rows) == valid
    sent = [r for r in rows if r.outcome != "Expired"]
    assert all(r.entries <= cfg.collection_max_count and r.first_send_us <= r.last_send_us <= r.flush_us for r in sent)
    assert all(r.bytes + 30 <= cfg.collection_max_size or r.entries == 1 for r in sent)
    assert max(r.entries for r in sent) > 1


def test_records_without_a_shard_travel_alone_and_unheld(spark, data_dir):
    cfg = D.PUT_CONFIG
    half = shards.shard_ranges(fx.three_shards(spark).filter("shard_no <> 1"))
    timed = fx.keyed(intake.assign_times(fx.user_records(spark, data_dir), cfg))
    items = materialize(D.as_items(D.pack(materialize(shards.shard_lookup(timed, half)), cfg)))
    shaped = D.shape(items.withColumn("flushed_ts", F.col("arrival_ts")), cfg, D.SHARD_RECORDS, D.SHARD_BYTES).collect()
    assert sum(r.n_records for r in shaped) == timed.count()
    lone = [r for r in shaped if r.shard_no == -1]
    assert lone and all(r.n_records == 1 and r.arrival_ts == r.flushed_ts for r in lone)
    assert max(r.n_records for r in shaped if r.shard_no != -1) > 1
    assert all(r.expired == (r.arrival_ts is None) and (r.expired or r.arrival_ts >= r.flushed_ts) for r in shaped)


def test_what_waits_too_long_expires_in_the_queue(spark, data_dir):
    """A shard that takes next to nothing: the first batches go, later ones expire, none is sent after its expiration."""
    cfg = D.PUT_CONFIG
    items = materialize(D.as_items(D.pack(fx.routed_table(spark, data_dir), cfg)))
    shaped = D.shape(items, cfg, S.Bucket(1.0, 1e-6), S.Bucket(1e6, 1.0)).collect()
    assert len(shaped) == items.count() and {r.expired for r in shaped} == {True, False}
    assert all(r.arrival_ts <= r.expiration_ts for r in shaped if not r.expired)

"""Delivery in rounds until nothing is pending."""
from pyspark.sql import functions as F

from sparkpack.operators import rounds as R
from sparkpack.plans import delivery as D
from sparkpack.sources import fixtures as fx

CFG, RULE = D.ROUND_CONFIG, D.ROUND_RULE


def routed(spark, data_dir):
    return fx.routed(fx.user_records(spark, data_dir), CFG)


def test_every_record_ends_in_one_state(spark, data_dir):
    rows = {r.source_id: r for r in D.delivery_rounds(spark, data_dir).collect()}
    records = {r.source_id: r for r in routed(spark, data_dir).collect()}
    assert set(rows) == set(records) and {r.state for r in rows.values()} == {"delivered", "failed", "expired"}
    for r in rows.values():
        codes = r.history.split("|")
        assert len(codes) == r.n_attempts and "ok" not in codes[:-1] and "Expired" not in codes[:-1] and "xx" not in codes[:-1]
        if r.state == "expired":                        # the error that led there stays in the history
            assert codes[-1] == "Expired" and codes[-2] in (fx.THROTTLED, "InternalFailure", "Wrong Shard")
            assert r.end_us > records[r.source_id].expiration_ts.timestamp() * 1e6


def test_a_service_that_never_answers_well_ends_in_expiry(spark, data_dir):
    def busy(batches, number):
        return R.answer_by_code(batches, F.lit(fx.THROTTLED), F.lit("busy"), F.lit(False), F.lit(5), CFG)
    attempts, rounds = R.deliver(routed(spark, data_dir).filter("source_id < 60"), busy, CFG, RULE)
    out = R.final_states(attempts).collect()
    assert len(out) == 60 and {r.state for r in out} == {"expired"} and rounds > 2
    for r in out:
        assert [a.attempt_no for a in r.attempts] == list(range(1, len(r.attempts) + 1))
        assert all(x.end_ts <= y.start_ts for x, y in zip(r.attempts, r.attempts[1:]))


def test_no_records(spark, data_dir):
    attempts, rounds = R.deliver(routed(spark, data_dir).filter("source_id < 0"), D.scripted, CFG, RULE)
    assert rounds == 0 and R.final_states(attempts).count() == 0

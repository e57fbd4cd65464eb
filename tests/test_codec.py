import hashlib
import random

from pyspark.sql import functions as F

import brute
from sparkpack.functions import keys as K
from sparkpack.operators import codec as C

SCHEMA = "batch long, pos long, source_id long, partition_key string, explicit_hash_key string, data binary"


def rows(n=400, seed=11):
    rnd, out = random.Random(seed), []
    for b in range(n // 20):
        for p in range(1 if b % 5 == 0 else rnd.randrange(2, 200 if b == 3 else 25)):
            key = rnd.choice([f"key{rnd.randrange(160)}", "ключ", " ", "same"])
            ehk = str(rnd.randrange(2**128)) if rnd.random() < 0.5 else None
            data = rnd.randbytes(rnd.choice([0, 1, 127, 128, 300, 20_000 if p == 1 else 5]))
            out.append((b, p, len(out), key, ehk, bytearray(data)))
    return out


def frame(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    now = F.timestamp_seconds(F.lit(0))
    return df.withColumns({"hash_key": K.effective_hash_key(F.col("explicit_hash_key"), F.col("partition_key")),
                           "arrival_ts": now, "deadline_ts": now, "expiration_ts": now})


def test_packed_bytes_and_round_trip(spark):
    data = rows()
    df = frame(spark, data)
    packed = C.aggregate_records(df, ["batch"]).collect()
    exact = {r.batch: r.exact_size for r in C.accurate_size(df.filter("partition_key <> ' '"), ["batch"]).collect()}
    for p in packed:
        members = [r for r in data if r[0] == p.batch]
        wire = bytes(p.data)
        assert p.source_ids == [r[2] for r in members] and p.exact_size == len(wire)
        expected = brute.exact([dict(size=len(r[5]), pk=r[3], ehk=r[4]) for r in members], True)
        assert len(wire) == expected
        if not any(r[3] == " " for r in members):
            assert exact[p.batch] == expected
        if len(members) == 1:
            assert wire == bytes(members[0][5]) and p.partition_key == members[0][3]
            continue
        assert wire[:4].hex() == "f3899ac2" and hashlib.md5(wire[4:-16]).digest() == wire[-16:] and p.partition_key == "a"
        found, error = C.unpack(wire[4:-16])
        assert error is None and found == [(r[3], r[4], bytes(r[5])) for r in members]
        key = int(members[0][4]) if members[0][4] else int.from_bytes(hashlib.md5(members[0][3].encode()).digest(), "little")
        assert p.explicit_hash_key == str(key)


def test_estimate(spark):
    data = rows(200, 12)
    got = {r.source_id: r.estimate for r in C.estimated_size(frame(spark, data), ["batch"]).collect()}
    for b in {r[0] for r in data}:
        members = [dict(size=len(r[5]), pk=r[3], ehk=r[4], id=r[2]) for r in data if r[0] == b]
        for i, m in enumerate(members):
            assert got[m["id"]] == brute.estimate(members[:i + 1], True)


def test_damaged_rows_pass_through(spark):
    good = C.aggregate_records(frame(spark, [(0, i, i, "k", None, bytearray(b"xy")) for i in range(3)]), ["batch"]).collect()[0]
    wire = bytes(good.data)
    def sealed(message):
        return wire[:4] + message + hashlib.md5(message).digest()
    cases = {
        "good": wire, "magic": b"\0" + wire[1:], "digest": wire[:-1] + bytes([wire[-1] ^ 1]), "short": wire[:19], "empty": b"",
        "not a message": sealed(b"\x0f\xff"), "cut": sealed(wire[4:-17]), "bad index": sealed(wire[4:-16] + bytes.fromhex("1a020863")),
    }
    df = spark.createDataFrame([(k, "p", bytearray(v)) for k, v in cases.items()], "case string, partition_key string, data binary")
    out = {}
    for r in C.deaggregate(df).collect():
        out.setdefault(r.case, []).append(r)
    for case in ("magic", "digest", "short", "empty", "not a message", "cut"):
        assert [(bytes(r.data), r.aggregated, r.partition_key, r.sub_sequence) for r in out[case]] == [(cases[case], False, "p", 0)], case
    assert [(bytes(r.data), r.sub_sequence, r.aggregated) for r in out["good"]] == [(b"xy", i, True) for i in range(3)]
    bad = sorted(out["bad index"], key=lambda r: r.sub_sequence)
    assert [r.error for r in bad] == [None] * 3 + ["key index 99 outside a table of 2"] and bad[3].sub_sequence == 3

import hashlib

from pyspark.sql import functions as F

from sparkpack.functions import keys as K
from sparkpack.functions import text as X
from sparkpack.operators import intake, shards
from sparkpack.sources import fixtures as fx


def test_hash_keys(spark):
    df = spark.range(3000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    for r in df.select("k", K.hash_key(F.col("k")).alias("le"), K.hash_key(F.col("k"), "big").alias("be")).collect():
        d = hashlib.md5(r.k.encode()).digest()
        assert (int(r.le), int(r.be)) == (int.from_bytes(d, "little"), int.from_bytes(d, "big")) and len(r.le) == 39


def test_digest_edges(spark):
    cases = ["0" * 32, "f" * 32, "8" + "0" * 31, "0" * 16 + "f" * 16, "f" * 16 + "0" * 16, f"{10**38:032x}"]
    df = spark.createDataFrame([(c,) for c in cases], "h string")
    got = {r.h: r.n for r in df.select("h", K.digest_to_decimal(F.col("h"), "big").alias("n")).collect()}
    assert got == {c: str(int(c, 16)).zfill(39) for c in cases}


def test_shard_boundaries(spark):
    ends = {2: 85070591730234615865843651857942052862, 3: 170141183460469231731687303715884105727, 1: 2**128 - 1}
    probes = {0: 2, ends[2]: 2, ends[2] + 1: 3, ends[3]: 3, ends[3] + 1: 1, ends[1]: 1}
    df = spark.createDataFrame([(str(k).zfill(39),) for k in probes], "hash_key string")
    got = shards.shard_lookup(df, shards.shard_ranges(fx.three_shards(spark)))
    assert {int(r.hash_key): r.shard_no for r in got.collect()} == probes
    half = shards.shard_ranges(fx.three_shards(spark).filter("shard_no <> 1"))
    assert {int(r.hash_key): r.shard_no for r in shards.shard_lookup(df, half).collect()} == {k: v if v != 1 else -1 for k, v in probes.items()}


def test_ranges_of_many_shards(spark):
    ends = sorted({str(hash((i, 1)) % 2**64 * 2**63 % 2**128).zfill(39) for i in range(500)})
    df = spark.createDataFrame([(i, e) for i, e in enumerate(ends)], "shard_no long, end_key string")
    got = {r.shard_no: r.start_key for r in shards.shard_ranges(df).collect()}
    assert got == {i: (ends[i - 1] if i else None) for i in range(len(ends))}


def test_validation_rules(spark):
    ok = ("s", "k", None, bytearray(b"x"))
    cases = [
        (ok, None), ((None, *ok[1:]), "stream"), (("  ", *ok[1:]), "stream"), (("s", None, *ok[2:]), "key null"),
        (("s", "", *ok[2:]), "key length"), (("s", "k" * 256, *ok[2:]), None), (("s", "k" * 257, *ok[2:]), "key length"),
        (("s", "k", "abc", ok[3]), "explicit key not a number"), (("s", "k", "-1", ok[3]), "explicit key not a number"),
        (("s", "k", str(2**128 - 1), ok[3]), None), (("s", "k", "000" + str(2**128 - 1), ok[3]), None),
        (("s", "k", str(2**128), ok[3]), "explicit key out of range"), (("s", "k", "1" * 40, ok[3]), "explicit key out of range"),
        (("s", "k", " 12 ", ok[3]), None), (("s", "k", None, bytearray(1024 * 1024)), None), (("s", "k", None, bytearray(1024 * 1024 + 1)), "data too large"),
    ]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, stream_name string, partition_key string, explicit_hash_key string, data binary")
    got = {r.i: r.reject_reason for r in intake.validate_records(df).select("i", "reject_reason").collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(cases)}


def test_text_helpers(spark):
    df = spark.createDataFrame([("a:b:c",), (":ab",), ("abc",), ("a:",)], "s string")
    got = [r.p for r in df.select(X.split_on_first(F.col("s"), ":").alias("p")).collect()]
    assert got == [["a", "b:c"], [":ab"], ["abc"], ["a", ""]]
    assert spark.range(1).select(X.form_url_encode(F.lit("a b/ü(1)!~*")).alias("u")).first().u == "a+b%2f%c3%bc(1)!%7e*"
    name = spark.range(1).select(K.shard_name(F.lit(7)).alias("n"), K.shard_number(F.lit("shardId-000000000007")).alias("i")).first()
    assert (name.n, name.i) == ("shardId-000000000007", 7)

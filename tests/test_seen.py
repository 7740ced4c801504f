import numpy as np
from pyspark.sql import functions as F

from boreal.operators.seen import Seen, dealt_join


def test_seen_forgets_no_key(spark):
    keys = spark.range(50_000).select(F.xxhash64("id").alias("k"))
    seen = Seen.of(keys, "k", 50_000)
    mine = np.array([r["k"] for r in keys.collect()], np.int64)
    assert seen.has(mine).all()
    assert seen.has(np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 20_000)).mean() < 0.08
    assert Seen.of(keys, "k", Seen.MOST + 1) is None
    assert not Seen.of(keys.limit(0), "k", 0).has(mine).any()


def test_crowded_keys_are_dealt_without_loss(spark):
    a = spark.createDataFrame([(k, i) for i in range(300) for k in (1 if i % 3 else i,)], "shard bigint, a bigint")
    b = spark.createDataFrame([(1, i) for i in range(40)] + [(3, 7), (None, 8)], "shard bigint, b bigint")
    want = sorted(tuple(r) for r in a.join(b, "shard").collect())
    for block in (16, 10_000):
        assert sorted(tuple(r) for r in dealt_join(a, b, block=block).select("shard", "a", "b").collect()) == want
    assert dealt_join(a.limit(0), b).collect() == []


def test_crowded_keys_meet_their_own_key_only_whatever_its_name(spark):
    a = spark.createDataFrame([(k, i) for i in range(300) for k in (1 if i % 3 else i,)], "k bigint, a bigint")
    b = spark.createDataFrame([(1, i) for i in range(40)] + [(3, 7), (None, 8)], "k bigint, b bigint")
    want = sorted(tuple(r) for r in a.join(b, "k").collect())
    for key in ("part", "parts"):
        got = dealt_join(a.withColumnRenamed("k", key), b.withColumnRenamed("k", key), key, block=16)
        assert got.columns == [key, "a", "b"]
        assert sorted(tuple(r) for r in got.collect()) == want

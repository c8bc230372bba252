import random

from pyspark.sql import functions as F

from shopstream.operators.skew import Skew, hot_keys, lookup_by_key, lookup_small


def table(spark, n=2000, tie=0.0):
    random.seed(1)
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", 7 if random.random() < tie else random.randrange(10_000), i) for i in range(n)]
    return spark.createDataFrame(rows, "k STRING, ts BIGINT, arrival BIGINT")


def test_hot_keys_are_those_above_the_limit_whatever_their_share(spark):
    df = table(spark)
    assert [tuple(r) for r in hot_keys(df, "k", Skew(100)).collect()] == [("hot", 7)]
    assert hot_keys(df, "k").collect() == []
    assert hot_keys(df, "k", Skew(10)).count() == 51


def test_lookup_by_key_finds_hot_and_cold(spark):
    df = table(spark, 300)
    facts = df.groupBy("k").agg(F.min("ts").alias("low")).where("k <> 'k1'")
    want = sorted((r.arrival, str(r.low)) for r in df.join(facts, "k", "left").collect())
    for skew in (Skew(), Skew(3), Skew(30)):
        out = lookup_by_key(df, facts, "k", ["arrival"], skew)
        assert sorted((r.arrival, str(r.low)) for r in out.collect()) == want


def test_lookup_small_is_the_same_above_its_limit(spark):
    df = table(spark, 100)
    small = spark.createDataFrame([("hot", 1), ("k1", 2)], "k STRING, v INT")
    want = sorted((r.arrival, str(r.v)) for r in df.join(small, "k", "left").collect())
    for limit in (10, 1):
        out = lookup_small(df, small, ["k"], F.col("arrival"), max_rows=limit, salts=4)
        assert sorted((r.arrival, str(r.v)) for r in out.collect()) == want

import random

import pytest
from pyspark.sql import functions as F

from shopstream.operators.ordered import PART, dealt_by_range, with_latest, with_neighbour


def rows_of(n=600, tie=0.0):
    random.seed(1)
    return [("hot" if i % 2 == 0 else f"k{i % 50}", 7 if random.random() < tie else random.randrange(10_000), i) for i in range(n)]


@pytest.fixture(params=[1, 4, 40])
def parts(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("after", [True, False])
@pytest.mark.parametrize("tie", [0.3, 1.0])
def test_neighbours_cross_partitions(spark, parts, after, tie):
    rows = rows_of(tie=tie)
    df = spark.createDataFrame(rows, "k STRING, ts BIGINT, arrival BIGINT").repartition(3)
    out = with_neighbour(df, "k", ["ts", "arrival"], F.col("arrival"), "n", after)
    assert out.columns == ["k", "ts", "arrival", "n"]
    ordered = sorted(rows)
    want = {}
    for a, b in zip(ordered, ordered[1:]):
        if a[0] == b[0]:
            want[a[2] if after else b[2]] = b[2] if after else a[2]
    assert {r.arrival: r.n for r in out.collect() if r.n is not None} == want


def test_null_values_are_values(spark, parts):
    rows = [("a", i, None if i % 3 else i) for i in range(60)]
    out = with_neighbour(spark.createDataFrame(rows, "k STRING, ts BIGINT, v BIGINT"), "k", ["ts"], F.col("v"), "n", False)
    assert sorted((r.ts, r.n) for r in out.collect()) == [(0, None)] + [(i, rows[i - 1][2]) for i in range(1, 60)]


def test_a_device_with_half_of_all_rows_is_spread_evenly(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    df = spark.createDataFrame(rows_of(8000), "k STRING, ts BIGINT, arrival BIGINT")
    sizes = [r["count"] for r in dealt_by_range(df, ["k"], ["ts", "arrival"]).groupBy(PART).count().collect()]
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(sizes) == 8 and max(sizes) <= 1.5 * 1000


def test_latest_fact(spark, parts):
    random.seed(4)
    facts = [(random.choice("aab"), random.randrange(100), f"v{i}") for i in range(40)]
    facts = list({(k, at): (k, at, v) for k, at, v in facts}.values()) + [(None, 1, "x"), ("a", None, "y")]
    rows = [(random.choice("aaaabc"), random.randrange(-5, 110), i) for i in range(400)] + [(None, 3, 900), ("a", None, 901)]
    out = with_latest(
        spark.createDataFrame(rows, "k STRING, at BIGINT, id INT"), spark.createDataFrame(facts, "k STRING, since BIGINT, v STRING"),
        ["k"], "at", "since", "fact",
    )
    assert out.columns == ["k", "at", "id", "fact"]

    def latest(k, at):
        known = [f for f in facts if k is not None and at is not None and f[0] == k and f[1] is not None and f[1] <= at]
        return max(known, key=lambda f: f[1])[1:] if known else None

    assert {r.id: tuple(r.fact) if r.fact else None for r in out.collect()} == {i: latest(k, at) for k, at, i in rows}


def test_empty_tables(spark, parts):
    none = spark.createDataFrame([], "k STRING, at BIGINT")
    assert with_neighbour(none, "k", ["at"], F.col("at"), "n", True).count() == 0
    some = spark.createDataFrame([("a", 1)], "k STRING, at BIGINT")
    facts = spark.createDataFrame([], "k STRING, since BIGINT, v STRING")
    assert [r.f for r in with_latest(some, facts, ["k"], "at", "since", "f").collect()] == [None]


def test_rows_of_the_as_of_join_are_worked_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(value):
        seen.add(1)
        return value

    df = spark.range(100).select((F.col("id") % 3).alias("k"), counted("id").alias("at"))
    facts = spark.createDataFrame([(0, 0, "x"), (1, 50, "y")], "k BIGINT, since BIGINT, v STRING")
    out = with_latest(df, facts, ["k"], "at", "since", "f", str(tmp_path)).collect()
    assert len(out) == 100 and sum(r.f is not None for r in out) == 34 + 16
    assert seen.value == 100

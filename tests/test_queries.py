"""Every batch query against its SQL, at the smallest scale. Streams have tests of their own."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import inputs, oracles, queries as catalog
from checks.compare import duck, duck_bag, spark_bag

SF_DIR = "/root/testdata/sf0.001"
STREAMED = {"two_jobs_one_store", "repair_rough_json"}
BATCH = [n for n in catalog.ALL if not n.startswith("stream_") and n not in STREAMED]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(catalog.ALL) == set(oracles.ALL) and set(catalog.ALL) <= set(entry.queries())


@pytest.mark.parametrize("name", BATCH)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    got, want = spark_bag(df), duck_bag(con, entry.oracle_sql()[name])
    assert got == want and got


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_changes_of_a_dimension_are_worked_out_once(spark, tmp_path, monkeypatch):
    orders = "SELECT id AS o_orderkey, id % 9 AS o_custkey, 'O' AS o_orderstatus, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS o_orderdate, 'LOW' AS o_orderpriority FROM range(1, 61)"
    spark.sql(orders).write.parquet(str(tmp_path / "orders.parquet"))
    seen, table = spark.sparkContext.accumulator(0), inputs.table

    def count(status):
        seen.add(1)
        return status

    counted = lambda *how: table(*how).withColumn("o_orderstatus", F.udf(count, "string")("o_orderstatus"))
    monkeypatch.setattr(inputs, "table", counted)
    assert len(catalog.dim_table_batches(spark, str(tmp_path)).collect()) == 9
    assert seen.value == 60

import pytest
from pyspark.sql import functions as F

from shopstream import schemas
from shopstream.operators import dims


@pytest.fixture
def changes(spark, topic):
    """Routed dimension rows from (type, data) pairs, in order."""

    def make(*records):
        raw = topic(*[{"type": t, "data": d} for t, d in records])
        return raw.select("value", "arrival", F.inline(F.array(F.from_json("value", "type STRING, data MAP<STRING, VARIANT>"))))

    return make


def rules(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (7 - len(r))) for r in rows], schemas.RULE)


@pytest.fixture
def table(spark, tmp_path):
    root = str(tmp_path / "dims")
    rule = ("t", "insert", "hbase", "dim_t", "id,name,phone", None, "SALT_BUCKETS = 4")
    dims.ensure_dim_table(spark, rules(spark, rule), root)
    return f"{root}/dim_t"


def root_of(table):
    return table.rpartition("/")[0]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


STEPS = [{"id": 1, "name": "a", "phone": "x"}, {"id": 1, "name": "b"}, {"id": 1, "phone": None}, {"id": 2, "name": "O'Neil"}]
AFTER = [[("1", "a", "x")], [("1", "b", "x")], [("1", "b", None)], [("1", "b", None), ("2", "O'Neil", None)]]


def test_upserts_touch_only_the_columns_present(spark, changes, table):
    for batch, (data, after) in enumerate(zip(STEPS, AFTER)):
        for _ in range(2):
            dims.upsert_dim(spark, changes(("insert", data)), table, batch)
            assert rows(dims.read_dim(spark, table)) == after


def test_steps_in_one_batch_give_the_same(spark, changes, table):
    dims.upsert_dim(spark, changes(*[("update", d) for d in STEPS]), table, 0)
    assert rows(dims.read_dim(spark, table)) == AFTER[-1]
    assert dims.dim_table(spark, table) == (table, "id", ["id", "name", "phone"])
    dims.upsert_dim(spark, changes(("update", {"id": 2, "phone": "y"})), table, 1)
    assert rows(dims.read_dim(spark, table)) == [("1", "b", None), ("2", "O'Neil", "y")]


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, changes, table, tmp_path):
    dims.upsert_dim(spark, changes(*[("insert", {"id": i, "name": "n"}) for i in range(200)]), table, 0)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "dims" / "rows").rglob("*.parquet")}
    dims.upsert_dim(spark, changes(("insert", {"id": 7, "name": "m"})), table, 1)
    after = {p for p in (tmp_path / "dims" / "rows").rglob("*.parquet")}
    assert len(before) == len(after) == dims.BUCKETS and len(after - set(before)) == 1
    assert dict(tuple(r)[:2] for r in dims.read_dim(spark, table).collect()) == {str(i): "m" if i == 7 else "n" for i in range(200)}


def test_a_batch_that_ended_while_it_replaced_buckets_is_made_whole(spark, changes, table, tmp_path):
    batch = changes(*[("insert", {"id": i, "name": "n"}) for i in range(50)])
    dims.upsert_dim(spark, batch, table, 0)
    spark.createDataFrame([], dims.ROW).write.mode("overwrite").partitionBy("table", "bucket").parquet(str(tmp_path / "dims" / "rows"))
    assert dims.read_dim(spark, table).count() == 0
    dims.upsert_dim(spark, batch, table, 0)
    assert dims.read_dim(spark, table).count() == 50


def test_a_routed_delete_writes_its_row_unless_applied(spark, changes, table):
    steps = [("insert", {"id": 1, "name": "a", "phone": "x"}), ("delete", {"id": 1, "name": "z"})]
    dims.upsert_dim(spark, changes(*steps), table, 0)
    assert rows(dims.read_dim(spark, table)) == [("1", "z", "x")]
    dims.upsert_dim(spark, changes(*steps), table, 1, apply_deletes=True)
    assert rows(dims.read_dim(spark, table)) == []
    # Written again later, the row holds nothing from before the delete.
    dims.upsert_dim(spark, changes(("insert", {"id": 1, "name": "n"})), table, 2, apply_deletes=True)
    assert rows(dims.read_dim(spark, table)) == [("1", "n", None)]
    dims.upsert_dim(spark, changes(*steps, ("insert", {"id": 1, "phone": "p"})), table, 3, apply_deletes=True)
    assert rows(dims.read_dim(spark, table)) == [("1", None, "p")]


def test_rows_the_table_cannot_take_are_marked(spark, changes):
    marked = dims.check_dim_rows(
        changes(("insert", {"id": 1}), ("insert", {"name": "a"}), ("insert", {"id": None}), ("insert", {"id": 1, "zip": 2})),
        "id", ["id", "name"],
    )
    assert {r.arrival: r.reject_reason for r in marked.collect()} == {0: None, 1: "no_key", 2: "no_key", 3: "unknown_column"}


def test_tables_are_made_only_for_inserting_dimension_rules(spark, tmp_path):
    root = str(tmp_path / "dims")
    table = rules(
        spark, ("a", "insert", "hbase", "dim_a", "id,n"), ("b", "update", "hbase", "dim_b", "id,n"),
        ("c", "insert", "kafka", "c", "id"), ("d", "insert", "hbase", "dim_d", None), ("e", "insert", "hbase", "dim_e", "x,y"),
        ("f", "insert", "hbase", "dim_f", "x,y", "y", "ext"),
    )
    reasons = {r.sink_table: r.reject_reason for r in dims.dim_rules(table).collect()}
    assert reasons == {"dim_a": None, "dim_d": "no_columns", "dim_e": "pk_not_a_column", "dim_f": None}
    for _ in range(2):
        dims.ensure_dim_table(spark, table, root)
        assert sorted(r.sink_table for r in spark.read.parquet(f"{root}/tables").collect()) == ["dim_a", "dim_f"]
    assert dims.table_exists(spark, f"{root}/dim_a") and not dims.table_exists(spark, f"{root}/dim_b")
    assert dims.dim_table(spark, f"{root}/dim_f").pk == "y"
    schema = dims.read_dim(spark, f"{root}/dim_f").schema
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [("x", "string"), ("y", "string")]
    assert schema["y"].metadata == {"primary_key": True, "extend": "ext"}
    # A changed rule never alters its table.
    dims.ensure_dim_table(spark, rules(spark, ("a", "insert", "hbase", "dim_a", "id,n,more")), root)
    assert dims.dim_table(spark, f"{root}/dim_a").columns == ["id", "n"]


def test_many_tables_take_one_batch_in_one_job(spark, changes, tmp_path):
    root, jobs = str(tmp_path / "dims"), []
    tracker = spark.sparkContext.statusTracker()
    for n in (2, 12):
        made = rules(spark, *[(f"s{i}", "insert", "hbase", f"dim_{i}", "id,name") for i in range(n)])
        dims.ensure_dim_table(spark, made, f"{root}/{n}")
        rows_ = changes(*[("insert", {"id": i, "name": f"n{i}"}) for i in range(n + 1)])
        routed = rows_.withColumn("sink_table", F.concat(F.lit("dim_"), F.col("arrival").cast("string")))
        spark.sparkContext.setJobGroup(f"upsert {n}", "")
        dims.upsert_dims(spark, routed, f"{root}/{n}", 0)
        jobs.append(len(tracker.getJobIdsForGroup(f"upsert {n}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert [rows(dims.read_dim(spark, f"{root}/{n}/dim_{i}")) for i in range(n)] == [[(str(i), f"n{i}")] for i in range(n)]
        refused = dims.mark_dim_rows(spark, routed, f"{root}/{n}").where("reject_reason IS NOT NULL").collect()
        assert [(r.arrival, r.reject_reason) for r in refused] == [(n, "no_table")]
    assert jobs[0] == jobs[1]

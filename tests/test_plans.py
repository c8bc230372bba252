import json

from pyspark.sql import functions as F

from conftest import log
from shopstream import names, schemas
from shopstream.functions.fields import is_entry_page, is_page, to_json_line
from shopstream.functions.times import day_start_millis
from shopstream.operators import dims
from shopstream.operators.logs import parse_log
from shopstream.operators.cdc import rule_versions
from shopstream.plans.changes import process_changes, start_changes, start_rules, stored_rules
from shopstream.session import run_dir, shared_dir, stage, stream_session
from shopstream.sinks.topics import kafka_write_options, land_raw_log, stream_records, topic_records, write_records, write_topic
from shopstream.sources.rules import read_envelopes, read_rules
from shopstream.sources.topics import FolderTopics, KafkaTopics, kafka_read_options, read_lines, read_topic, read_topics
from shopstream.streaming.rules import read_versions

RULES = [
    ("t", "insert", "hbase", "dim_t", "id,name", None, None),
    ("t", "update", "hbase", "dim_t", "id,name,zip", None, None),
    ("u", "update", "hbase", "dim_unmade", "id", None, None),
    ("f", "insert", "kafka", "fact_f", None, None, None),
]


def change(table, type, **data):
    return {"table": table, "type": type, "data": data}


CHANGES = [
    change("t", "insert", id=1, name="a"), change("f", "insert", id=7), change("t", "bootstrap-insert", id=2, name="b"),
    change("t", "update", id=1, name="c"), change("t", "update", id=1, zip="9"), change("u", "update", id=3),
    {"table": "t", "data": {"id": 1}}, "no json", change("x", "insert", id=1), change("t", "insert", name="nobody"),
]


def results(spark, facts, root):
    bad = spark.read.parquet(f"{root}/_quarantine").select("reject_reason").collect()
    return (
        sorted(tuple(r) for r in dims.read_dim(spark, f"{root}/dim_t").collect()),
        [json.loads(r.value) for r in read_topic(spark, facts, "fact_f").collect()],
        sorted(r.reject_reason for r in bad),
    )


WANT = ([("1", "c"), ("2", "b")], [{"id": 7}], ["bad_json", "no_key", "no_table", "no_type", "unknown_column"])


def test_a_batch_of_changes_can_be_repeated(spark, topic, tmp_path):
    facts, root = FolderTopics(str(tmp_path / "facts")), str(tmp_path / "dims")
    rules = spark.createDataFrame(RULES, schemas.RULE)
    for _ in range(2):
        process_changes(topic(*CHANGES), rules, facts, root, 0, str(tmp_path / "stage"))
        assert results(spark, facts, root) == WANT


def test_a_batch_of_one_file_is_dealt_out_and_parsed_once(spark, topic, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    records = [*CHANGES, *[change("f", "insert", id=i) for i in range(50)]]
    raw = topic(*records).coalesce(1).withColumn("value", F.udf(count, "string")("value"))
    rules = spark.createDataFrame(RULES, schemas.RULE)
    facts, root, scratch = FolderTopics(str(tmp_path / "facts")), str(tmp_path / "dims"), tmp_path / "stage"
    process_changes(raw, rules, facts, root, 0, str(scratch))
    bad = spark.read.parquet(f"{root}/_quarantine").select("reject_reason").collect()
    assert seen.value == len(records) and sorted(r.reject_reason for r in bad) == WANT[2]
    assert len(list(scratch.glob("run-*/changes/route=fact/*.parquet"))) > 1


def test_jobs_that_share_the_checkpoint_folder_keep_apart(spark, topic, tmp_path):
    rules = spark.createDataFrame(RULES, schemas.RULE)
    for name, records in (("a", CHANGES), ("b", [change("f", "insert", id=8)]), ("a", CHANGES)):
        process_changes(topic(*records), rules, FolderTopics(str(tmp_path / name)), str(tmp_path / f"dims-{name}"), 0)
    assert results(spark, FolderTopics(str(tmp_path / "a")), str(tmp_path / "dims-a")) == WANT
    assert [json.loads(r.value) for r in read_topic(spark, FolderTopics(str(tmp_path / "b")), "fact_f").collect()] == [{"id": 8}]


def test_writers_share_a_root(spark, topic, tmp_path):
    store = FolderTopics(str(tmp_path / "topics"))
    assert read_topic(spark, store, "one").count() == 0
    write_topic(topic("a", "b"), store, "source")
    for name in ("first", "second"):
        stream = topic_records(read_topic(spark, store, "source", streaming=True), "one")
        stream_records(stream, store, str(tmp_path / name), once=True, name=name).awaitTermination()
    write_records(topic_records(topic("c"), "one"), store, 3, "third")
    write_records(topic_records(topic("d"), "one"), store, 3, "third")
    write_records(topic_records(topic("e"), "two"), store, 4, "third")
    assert sorted(r.value for r in read_topic(spark, store, "one").collect()) == ["a", "a", "b", "b", "d"]
    assert sorted(r.topic for r in read_topics(spark, store).collect()) == ["one"] * 5 + ["source"] * 2 + ["two"]
    # A new checkpoint numbers its batches anew, and must not replace those of the old one.
    again = topic_records(read_topic(spark, store, "source", streaming=True), "one")
    stream_records(again, store, str(tmp_path / "new"), once=True, name="first").awaitTermination()
    assert read_topic(spark, store, "one").count() == 7


def test_change_stream_reads_the_rules_for_every_batch(spark, topic, tmp_path):
    session = stream_session(spark, 2)
    source, facts, root = FolderTopics(str(tmp_path / "in"), 1), FolderTopics(str(tmp_path / "facts")), str(tmp_path / "dims")
    loads = []

    def load_rules(s):
        loads.append(1)
        return s.createDataFrame(RULES, schemas.RULE)

    records = topic_records(topic(*CHANGES), names.ODS_CHANGES)
    for part in ("arrival < 4", "arrival >= 4"):
        write_records(records.where(part).coalesce(1), source)
    start_changes(session, source, facts, root, load_rules, str(tmp_path / "state"), once=True).awaitTermination()
    assert results(spark, facts, root) == WANT and len(loads) == 2


def test_topics_keep_records_apart(spark, topic, tmp_path):
    store = FolderTopics(str(tmp_path / "topics"))
    write_topic(topic(log("1"), log("2")), store, "one")
    write_topic(spark.createDataFrame([(1, None)], "a INT, b INT"), store, "two")
    assert sorted((r.arrival, json.loads(r.value)["common"]["mid"]) for r in read_topic(spark, store, "one").collect()) == [(0, "1"), (1, "2")]
    assert [r.value for r in read_topic(spark, store, "two").collect()] == ['{"a":1}']
    stream = read_topic(spark, store, "one", streaming=True)
    copy = FolderTopics(str(tmp_path / "copy"))
    write_topic(stream, copy, "three", str(tmp_path / "state"), once=True).awaitTermination()
    assert read_topic(spark, copy, "three").count() == 2


def test_raw_logs_land_by_day(spark, topic, tmp_path):
    raw = topic("line one", "line two").withColumn("at", F.timestamp_seconds(F.col("arrival") * 86400))
    land_raw_log(raw, str(tmp_path / "raw"), "at")
    assert read_lines(spark, str(tmp_path / "raw" / "dt=1970-01-02")).first().value == "line two"
    stream = read_lines(spark, str(tmp_path / "raw" / "*"), streaming=True)
    land_raw_log(stream, str(tmp_path / "again"), None, str(tmp_path / "state"), once=True).awaitTermination()
    assert spark.read.text(str(tmp_path / "again")).count() == 2


def test_rules_from_envelope_files(spark, tmp_path):
    folder = tmp_path / "rules"
    folder.mkdir()
    (folder / "a.json").write_text('{"topic":"s.db.tp","op":"CREATE","ts_ms":3,"after":{"source_table":"t"}}\n{"topic":"s.db.tp","op":"CRE\n')
    assert [r.reject_reason for r in read_envelopes(spark, str(folder)).collect()] == [None, "bad_json"] and read_rules(spark, str(folder)).count() == 1
    row = read_rules(spark, str(folder)).first()
    assert (row.database, row.table, row.type, row.version, row.data) == ("db", "tp", "insert", 3, {"source_table": "t"})
    assert read_rules(spark, str(folder), streaming=True).isStreaming


RULE_FIELDS = [f.split()[0] for f in schemas.RULE.split(", ")]


def envelopes(rows, at=0, op="READ"):
    return [
        json.dumps({"topic": "s.db.tp", "op": op, "ts_ms": at + i, ("before" if op == "DELETE" else "after"): {k: v for k, v in zip(RULE_FIELDS, r) if v}})
        for i, r in enumerate(rows)
    ]


def keep_rules(spark, tmp_path, *steps, **how):
    """The rule job run over batches of envelope texts, each at its (position, texts)."""
    session, source, rejects = stream_session(spark, 2), FolderTopics(str(tmp_path / "rule-in")), FolderTopics(str(tmp_path / "rejects"))
    for at, texts in steps:
        rows = spark.createDataFrame([(t, at + i) for i, t in enumerate(texts)], schemas.TOPIC)
        write_records(topic_records(rows, names.ODS_RULES), source)
        start_rules(session, source, names.ODS_RULES, str(tmp_path / "rules"), rejects, str(tmp_path / "rule-state"), once=True, **how).awaitTermination()
    return rejects


def test_the_change_job_takes_its_rules_from_the_rule_job(spark, topic, tmp_path):
    rejects = keep_rules(spark, tmp_path, (-10, [*envelopes(RULES), "no json", '{"topic":"s.db.tp"}', '{"topic":"x","op":"READ","after":{}}']))
    facts, root = FolderTopics(str(tmp_path / "facts")), str(tmp_path / "dims")
    process_changes(topic(*CHANGES), stored_rules(str(tmp_path / "rules"))(spark), facts, root, 0, str(tmp_path / "stage"))
    assert results(spark, facts, root) == WANT
    bad = read_topic(spark, rejects, names.REJECTED).collect()
    assert sorted(json.loads(r.value)["reject_reason"] for r in bad) == ["bad_json", "no_op", "no_table"]


def test_a_replay_is_routed_as_the_first_time(spark, topic, tmp_path):
    facts, root, load = FolderTopics(str(tmp_path / "facts")), str(tmp_path / "dims"), stored_rules(str(tmp_path / "rules"))
    keep_rules(spark, tmp_path, (-10, envelopes(RULES)))
    process_changes(topic(*CHANGES), load(spark), facts, root, 0, str(tmp_path / "stage"))
    moved = [("f", "insert", "kafka", "elsewhere", None, None, None), ("t", "update", "kafka", "elsewhere", None, None, None)]
    keep_rules(spark, tmp_path, (1000, envelopes(moved)))
    process_changes(topic(*CHANGES), load(spark), facts, root, 0, str(tmp_path / "stage"))
    assert results(spark, facts, root) == WANT and read_topic(spark, facts, "elsewhere").count() == 0
    now = {(r.source_table, r.operate_type): r.sink_table for r in stored_rules(str(tmp_path / "rules"), by_position=False)(spark).collect()}
    assert now[("f", "insert")] == "elsewhere"


def test_versions_are_kept_only_where_a_rule_changes(spark, tmp_path):
    one = [("t", "insert", "kafka", "a", None, None, None)]
    other = [("t", "insert", "kafka", "b", None, None, None)]
    steps = [(0, envelopes(one)), (5, envelopes(one)), (9, envelopes(other) + envelopes(one, op="DELETE")), (20, envelopes(one) * 2), (3, envelopes(other))]
    keep_rules(spark, tmp_path, *steps, honor_deletes=True)
    versions = rule_versions(read_versions(spark, str(tmp_path / "rules")), honor_deletes=True).orderBy("valid_from").collect()
    assert [(r.valid_from, r.valid_until, r.sink_table, r.gone) for r in versions] == [
        (0, 3, "a", False), (3, 9, "b", False), (9, 10, "b", False), (10, 20, "a", True), (20, None, "a", False),
    ]


def test_kafka_options():
    store = KafkaTopics("host:9092", "group", max_offsets_per_trigger=5)
    assert kafka_read_options(store, "t", streaming=False) == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "t", "kafka.group.id": "group",
    }
    assert kafka_read_options(store, "t", streaming=True)["maxOffsetsPerTrigger"] == "5"
    assert kafka_write_options(store)["kafka.transaction.timeout.ms"] == "900000"


def test_shared_folder_is_the_clusters(spark, tmp_path):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir") and shared_dir(spark, "/given/") == "/given"
    assert run_dir(spark) != run_dir(spark)
    staged = stage(spark.range(3), f"{shared_dir(spark)}/numbers")
    assert staged.count() == 3 and "Parquet" in staged._jdf.queryExecution().executedPlan().toString().title()


def test_small_expressions(spark, topic):
    pages = parse_log(topic(log(last=None), log(last=""), log(last="x", page_id=""), log(page_id=None, last="y"))).orderBy("arrival")
    assert [(r[0], r[1]) for r in pages.select(is_entry_page(F.col("page")), is_page(F.col("page"))).collect()] == [
        (True, True), (True, True), (False, False), (False, False),
    ]
    days = spark.createDataFrame([("2021-01-01 23:59:59",), ("2021-1-2",), ("x",), (None,)], "t STRING")
    assert [r[0] for r in days.select(day_start_millis(F.col("t"))).collect()] == [1609459200000, 1609545600000, None, None]
    line = spark.createDataFrame([(1, None, "a")], "a INT, b INT, c STRING")
    assert line.select(to_json_line(F.struct("a", "b", "c"))).first()[0] == '{"a":1,"c":"a"}'

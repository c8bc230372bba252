import json

import pytest

from shopstream import schemas
from shopstream.operators.cdc import annotate_cdc, clean_cdc, current_rules, parse_cdc, route_cdc, rule_changes
from shopstream.operators.rejects import accepted, quarantined
from shopstream.sinks.topics import fact_records
from shopstream.sources.rules import flatten_cdc


def change(table="t", type="insert", **data):
    return {"table": table, "type": type, "data": data}


@pytest.fixture
def rules(spark):
    def make(*rows):
        full = [(*r, *[None] * (7 - len(r))) for r in rows]
        return spark.createDataFrame(full, schemas.RULE)

    return make


@pytest.fixture
def clean(topic):
    return lambda *records: clean_cdc(accepted(parse_cdc(topic(*records))))


def test_only_changes_with_a_table_and_data_stay(topic, clean):
    records = [
        change(id=1), {"type": "insert", "data": {"id": 1}}, change("", id=1), {"table": "t", "type": "insert"},
        change(), change(id=None), {"table": "t", "type": "insert", "data": "text"}, change(id=None, a=""),
        {"table": "t", "data": {"id": 1}},
    ]
    assert sorted(r.arrival for r in clean(*records).collect()) == [0, 7, 8]
    bad = quarantined(parse_cdc(topic("no json", None, change(id=1))))
    assert sorted(r.arrival for r in bad.collect()) == [0, 1]


def test_repeated_keys_are_settled_once(clean):
    plan = clean(change(id=1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_from_entries") == 1


def test_routes(clean, rules):
    table = rules(
        ("t", "insert", "hbase", "dim_t"), ("f", "update", "kafka", "fact_f"), ("c", "insert", "clickhouse", "any"),
        ("n", "insert", None, "x"), (None, None, "kafka", "never"),
    )
    routed = route_cdc(
        clean(
            change("t", id=1), change("t", "bootstrap-insert", id=2), change("f", "update", id=3), change("f", id=4),
            change("c", id=5), change("n", id=6), {"table": "t", "data": {"id": 7}}, change("t", "INSERT", id=8),
        ),
        table,
    )
    got = {name: sorted(r.arrival for r in df.collect()) for name, df in routed._asdict().items()}
    assert got == {"dim": [0, 1], "fact": [2], "unrouted": [4, 5], "unmatched": [3, 7], "rejected": [6]}
    dims = routed.dim.collect()
    assert {r.type for r in dims} == {"insert"} and {r.sink_table for r in dims} == {"dim_t"} and {r.sink_pk for r in dims} == {"id"}


@pytest.mark.parametrize(
    "columns,kept", [(None, {"id", "name", " x"}), ("", {"id", "name", " x"}), ("id,name", {"id", "name"}), ("id, name, x", {"id", " x"})]
)
def test_columns_are_taken_as_written(clean, rules, columns, kept):
    record = {"table": "t", "type": "insert", "data": {"id": 1, "name": "a", " x": 2}}
    out = annotate_cdc(clean(record), rules(("t", "insert", "kafka", "f", columns)))
    assert set(json.loads(fact_records(out).first().value)) == kept


def test_a_fact_is_its_data_alone_with_types_and_without_nulls(clean, rules):
    routed = route_cdc(clean(change(id=1, price=1.5, name="a'b", gone=None, deep={"x": [1]})), rules(("t", "insert", "kafka", None)))
    record = fact_records(routed.fact).first()
    assert json.loads(record.value) == {"id": 1, "price": 1.5, "name": "a'b", "deep": {"x": [1]}}
    assert record.topic == "DEFAULT_DATA"


def envelope(op, i, before=None, after=None):
    return {"topic": "server.shop.table_process", "op": op, "ts_ms": i, "before": before, "after": after}


def rule(table, sink, op="insert"):
    return {"source_table": table, "operate_type": op, "sink_type": "kafka", "sink_table": sink}


def test_envelopes_are_flattened(topic):
    raw = topic(envelope("CREATE", 1, after={"a": 1}), envelope("Read", 2, after={"a": "x"}), envelope("DELETE", 3, before={"a": 1}))
    rows = flatten_cdc(raw).orderBy("version").collect()
    assert [(r.database, r.table, r.type, r.data) for r in rows] == [
        ("shop", "table_process", "insert", {"a": "1"}), ("shop", "table_process", "read", {"a": "x"}),
        ("shop", "table_process", "delete", {}),
    ]


def test_the_last_rule_wins_and_deleted_ones_stay_unless_asked(topic):
    raw = topic(
        envelope("READ", 1, after=rule("a", "old")), envelope("UPDATE", 2, after=rule("a", "new")),
        envelope("READ", 3, after=rule("b", "b1")), envelope("DELETE", 4, before=rule("b", "b1")),
        # A rule whose key changes leaves the old key in force.
        envelope("READ", 5, after=rule("c", "c1")), envelope("UPDATE", 6, before=rule("c", "c1"), after=rule("d", "d1")),
    )
    changes = rule_changes(flatten_cdc(raw))
    kept = {r.source_table: r.sink_table for r in current_rules(changes).collect()}
    assert kept == {"a": "new", "b": "b1", "c": "c1", "d": "d1"}
    honored = {r.source_table: r.sink_table for r in current_rules(changes, honor_deletes=True).collect()}
    assert honored == {"a": "new", "c": "c1", "d": "d1"}

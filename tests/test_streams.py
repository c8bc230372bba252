import json
import random
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import queries
from conftest import log
from shopstream import names, schemas
from shopstream.functions.times import DAY_MS, position
from shopstream.operators import logs, visits
from shopstream.operators.rejects import accepted
from shopstream.plans import logs as log_plan
from shopstream.plans import orders as order_plan
from shopstream.plans import visits as visit_plan
from shopstream.session import stream_session
from shopstream.sinks.topics import stream_records, topic_records, write_records
from shopstream.sources.topics import FolderTopics, read_topic, read_topics
from shopstream.streaming import devices, processors


@pytest.fixture
def feed(spark, tmp_path):
    """A topic fed in steps, each of which becomes one micro-batch."""
    store = FolderTopics(str(tmp_path / "in"), 1)

    def make(topic, *steps):
        at = 0
        for step in steps:
            rows = [(r if isinstance(r, str) else json.dumps(r), at + i) for i, r in enumerate(step)]
            at += len(rows)
            df = spark.createDataFrame(rows, schemas.TOPIC)
            write_records(topic_records(df, topic).coalesce(1), store)
        return store

    return make


@pytest.fixture
def streams(spark):
    return stream_session(spark, 2)


def written(spark, store):
    return read_topics(spark, store).collect() if list(Path(store.root).glob("writer=*/_SUCCESS")) else []


def out(spark, store, topic):
    return read_topic(spark, store, topic).collect()


def random_logs(n, days=4):
    random.seed(n)
    return [
        log(random.choice("aaabcd"), random.randrange(days) * DAY_MS + i * 1000, last=random.choice([None, "x"]),
            is_new=random.choice("01"), displays=[{"i": 1}] * random.randrange(3))
        for i in range(n)
    ]


def test_log_stream_equals_batch(spark, streams, feed, tmp_path):
    records = random_logs(90)
    source = feed(names.ODS_LOG, records[:30], ["no json"], records[30:60], records[60:])
    target = FolderTopics(str(tmp_path / "out"))
    log_plan.start_logs(streams, source, target, str(tmp_path / "state"), once=True).awaitTermination()
    batch = FolderTopics(str(tmp_path / "batch"))
    rejected = log_plan.run_logs(spark, source, batch)
    assert [r.reject_reason for r in rejected.collect()] == ["bad_json"]
    kept = [json.loads(r.value) for r in out(spark, target, names.REJECTED)]
    assert kept == [{"source": names.ODS_LOG, "reject_reason": "bad_json", "value": "no json"}]
    for topic in (names.START_LOG, names.PAGE_LOG, names.DISPLAY_LOG):
        got = [sorted((r.arrival, json.dumps(json.loads(r.value), sort_keys=True)) for r in out(spark, s, topic)) for s in (target, batch)]
        assert got[0] == got[1]
    path = str(tmp_path / "bad")
    log_plan.start_quarantine(streams, source, path, str(tmp_path / "bad-state"), once=True).awaitTermination()
    assert [r.value for r in spark.read.parquet(path).collect()] == ["no json"]


def test_visit_stream_equals_batch(spark, streams, feed, tmp_path):
    records = random_logs(90)
    source = feed(names.PAGE_LOG, records[:20], records[20:50], records[50:])
    target = FolderTopics(str(tmp_path / "out"))
    visit_plan.start_unique_visit(streams, source, target, str(tmp_path / "state"), ttl=False, once=True).awaitTermination()
    batch = FolderTopics(str(tmp_path / "batch"))
    assert visit_plan.run_visits(spark, source, batch).count() == 0
    got = [sorted(r.arrival for r in out(spark, s, names.UNIQUE_VISIT)) for s in (target, batch)]
    assert got[0] == got[1] and got[0]
    with pytest.raises(ValueError):
        visit_plan.start_unique_visit(streams, source, target, str(tmp_path / "s2"), once=True)


def test_visit_stream_with_expiry_ends_by_its_progress(spark, streams, feed, tmp_path):
    source = feed(names.PAGE_LOG, [log(ts=0), log(ts=1), log(ts=DAY_MS)], [log(ts=DAY_MS + 1), log("b", 5)])
    target = FolderTopics(str(tmp_path / "out"))
    assert visit_plan.run_until_idle(visit_plan.start_unique_visit(streams, source, target, str(tmp_path / "state"))) == 2
    assert sorted(r.arrival for r in out(spark, target, names.UNIQUE_VISIT)) == [0, 2, 4]


def test_a_day_expires_by_the_wall_clock(spark, streams, feed, tmp_path, monkeypatch):
    monkeypatch.setattr(devices, "DAY_MS", 1)
    source = feed(names.PAGE_LOG, [log(ts=0)], [log(ts=1)])
    target = FolderTopics(str(tmp_path / "out"))
    visit_plan.run_until_idle(visit_plan.start_unique_visit(streams, source, target, str(tmp_path / "state")))
    assert sorted(r.arrival for r in out(spark, target, names.UNIQUE_VISIT)) == [0, 1]


def daily(spark, streams, source, tmp_path, **how):
    target = FolderTopics(str(tmp_path / "out"))
    visit_plan.start_unique_visit(streams, source, target, str(tmp_path / "state"), "daily", once=True, **how).awaitTermination()
    late = [json.loads(r.value) for r in out(spark, target, names.REJECTED)] if list(Path(target.root).glob("*/topic=rejected*")) else []
    return sorted(r.arrival for r in out(spark, target, names.UNIQUE_VISIT)), [r["reject_reason"] for r in late]


def test_daily_visit_stream_keeps_the_first_of_each_day(spark, streams, feed, tmp_path):
    days = [log(m, d * DAY_MS + i) for i, (m, d) in enumerate([("a", 0), ("a", 0), ("b", 0), ("a", 1), ("a", 1), ("b", 1)])]
    source = feed(names.PAGE_LOG, days[:2], days[2:4], days[4:])
    assert daily(spark, streams, source, tmp_path) == ([0, 2, 3, 5], [])


def test_a_late_entry_counts_while_its_day_is_known(spark, streams, feed, tmp_path):
    # The watermark is at the end of day 2 when day 1 comes again: for "a" it is forgotten, and late.
    steps = [[log("a", DAY_MS + 5)], [log("z", 3 * DAY_MS + 1)], [log("a", DAY_MS + 9), log("b", 3 * DAY_MS - 9)], [log("b", 3 * DAY_MS - 8)]]
    assert daily(spark, streams, feed(names.PAGE_LOG, *steps), tmp_path, delay="1 hour") == ([0, 1, 3], ["late"])


def jumps(spark, streams, source, tmp_path):
    target = FolderTopics(str(tmp_path / "out"))
    visit_plan.start_jump_detail(streams, source, target, str(tmp_path / "state"), once=True).awaitTermination()
    return sorted(r.arrival for r in out(spark, target, names.USER_JUMP))


def test_jump_stream_equals_batch_so_far(spark, streams, feed, tmp_path):
    random.seed(11)
    # Unordered within a step, never behind the watermark across steps.
    steps = [
        [log(random.choice("aaab"), base + random.randrange(40_000), last=random.choice([None, "x"])) for _ in range(25)]
        for base in (0, 40_000, 80_000)
    ]
    source = feed(names.PAGE_LOG, *steps)
    pages = accepted(logs.parse_log(read_topic(spark, source, names.PAGE_LOG)))
    want = sorted(r.arrival for r in visits.jump_detail(pages, complete=False).collect())
    assert jumps(spark, streams, source, tmp_path) == want and want


def test_late_pages_are_told_and_counted(spark, streams, feed, tmp_path):
    # The third page would cancel the first bounce, but comes after the watermark has passed it.
    steps = [[log("a", 1)], [log("b", 60_000)], [log("a", 5_000, last="x"), log("b", 90_000, last="x")], [log("c", 200_000)]]
    source, target = feed(names.PAGE_LOG, *steps), FolderTopics(str(tmp_path / "out"))
    query = visit_plan.start_jump_detail(streams, source, target, str(tmp_path / "state"), once=True)
    query.awaitTermination()
    assert sorted(r.arrival for r in out(spark, target, names.USER_JUMP)) == [0, 1]
    late = out(spark, target, names.REJECTED)
    assert [(r.arrival, json.loads(json.loads(r.value)["value"])["ts"]) for r in late] == [(2, 5_000)]
    counts = [p.observedMetrics[names.USER_JUMP].asDict() for p in query.recentProgress if p.observedMetrics]
    assert sum(c["kept"] for c in counts) == 2 and sum(c["late"] for c in counts) == 1


def test_jump_stream_with_pages_across_stretches(spark, streams, feed, tmp_path, monkeypatch):
    monkeypatch.setattr(processors.Bounce.__init__, "__defaults__", ("BIGINT", 10_000))
    random.seed(12)
    steps = [[log(random.choice("aab"), base + random.randrange(90_000), last=random.choice([None, "x"])) for _ in range(40)] for base in (0, 90_000, 180_000)]
    source = feed(names.PAGE_LOG, *steps)
    pages = accepted(logs.parse_log(read_topic(spark, source, names.PAGE_LOG)))
    assert jumps(spark, streams, source, tmp_path) == sorted(r.arrival for r in visits.jump_detail(pages, complete=False).collect())


def test_positions_over_partitions(spark, streams, tmp_path):
    """Visits, bounces and flags of records dealt to partitions whose offsets overlap, by batch and by stream."""
    random.seed(3)
    records = [log(random.choice("aab"), i * 4_000_000, last=random.choice([None, "x"]), is_new="1") for i in range(60)]
    rows = [(json.dumps(r), r["ts"] // 8_000_000, i % 3, 1000 - 900 * (i % 3) + i) for i, r in enumerate(records)]
    raw = spark.createDataFrame(rows, "value STRING, time BIGINT, partition INT, offset BIGINT")
    raw = raw.select("value", position(raw["time"], raw["partition"], raw["offset"]).alias("arrival"))
    for i, part in enumerate(("arrival.time < 10", "arrival.time >= 10")):
        raw.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    one = spark.createDataFrame([(r[0], i) for i, r in enumerate(sorted(rows, key=lambda r: r[1:]))], schemas.TOPIC)
    read = [accepted(logs.parse_log(df)) for df in (raw, one)]
    def texts(df):
        return sorted(r.value for r in df.select("value").collect())
    for operator in (visits.unique_visit, visits.jump_detail, logs.repair_is_new):
        assert texts(operator(read[0])) == texts(operator(read[1]))
    source = streams.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    pages, target = accepted(logs.parse_log(source)), FolderTopics(str(tmp_path / "out"))
    for name, seen in (("visits", devices.unique_visit(pages, ttl=False)), ("daily", devices.unique_visit(pages, "daily"))):
        stream_records(devices.visit_records(seen, name, "in"), target, str(tmp_path / name), once=True, name=name).awaitTermination()
    stream_records(devices.visit_records(devices.jump_detail(pages), "jumps", "in"), target, str(tmp_path / "j"), once=True, name="j").awaitTermination()
    stream_records(devices.repaired_records(pages), target, str(tmp_path / "r"), once=True, name="r").awaitTermination()
    assert sorted(r.value for r in out(spark, target, "visits")) == texts(visits.unique_visit(read[1]))
    assert sorted(r.value for r in out(spark, target, "daily")) == texts(visits.unique_visit(read[1], "daily"))
    assert sorted(r.value for r in out(spark, target, "jumps")) == texts(visits.jump_detail(read[1], complete=False))
    assert sorted(r.value for r in out(spark, target, names.PAGE_LOG)) == texts(logs.repair_is_new(read[1]))


def test_the_order_stream_forgets_what_can_match_no_more(spark, streams, feed, tmp_path):
    def at(s):
        return f"2021-01-01 {s // 3600:02}:{s // 60 % 60:02}:{s % 60:02}"

    seconds = [60 * i for i in range(120)]
    steps = [[{"id": s, "create_time": at(s), "user_id": 1} for s in seconds[i:i + 30]] for i in range(0, 120, 30)]
    source = feed(names.ORDER_INFO, *steps)
    feed(names.ORDER_DETAIL, *[[{"id": r["id"], "order_id": r["id"], "create_time": r["create_time"], "sku_num": 2} for r in step] for step in steps])
    wide = order_plan.stream_order_wide(streams, source, "second", delay="10 minutes")
    state = str(tmp_path / "state")
    writer = wide.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
    writer.format("parquet").start(str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 120
    for side, keeps in (("left", {"user_id", "total_amount"}), ("right", {"sku_num"})):
        held = spark.read.format("statestore").option("joinSide", side).load(state).select("value.*")
        names_held = {c.removeprefix("_extract_") for c in held.columns}
        at = next(c for c in held.columns if c.endswith("_time") and "create" not in c)
        times = [r[0].timestamp() % 86400 for r in held.select(at).collect()]
        assert times and min(times) >= seconds[-1] - 600 - 5 - 60
        assert keeps <= names_held and not {"value", "arrival", "expire_time", "create_hour"} & names_held


def test_orders_of_a_minute_are_kept_as_bundles(spark, streams, feed, tmp_path):
    def at(s):
        return f"2021-01-01 {s // 3600:02}:{s // 60 % 60:02}:{s % 60:02}"

    times = [(i, i % 50 + 3000 * (i // 1000)) for i in range(2000)]
    info = [{"id": i % 900, "create_time": at(s), "user_id": i} for i, s in times]
    lines = [{"id": i, "order_id": i % 900, "create_time": at(s + i % 12), "sku_name": f"s{i}"} for i, s in times]
    source = feed(names.ORDER_INFO, info[:500], info[500:])
    feed(names.ORDER_DETAIL, lines[:700], lines[700:])
    wide = order_plan.stream_order_wide(streams, source, "second", delay="1 hour")
    writer = wide.writeStream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
    writer.format("parquet").start(str(tmp_path / "out")).awaitTermination()
    got = sorted((r.order_id, r.user_id, r.detail_id, r.sku_name) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    rows = order_plan.run_order_wide(spark, source, "second")[0].collect()
    assert got == sorted((r.order_id, r.user_id, r.detail_id, r.sku_name) for r in rows) and len(got) > 900
    for side in ("left", "right"):
        held = spark.read.format("statestore").option("joinSide", side).load(str(tmp_path / "state"))
        assert 0 < held.count() < 300


def test_no_line_is_late_for_the_files_of_its_step(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "STREAM_FILES", 1)
    session = queries.stream_session
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}

    def many_files(*args):
        found = session(*args)
        for key, value in small.items():
            found.conf.set(key, value)
        return found

    monkeypatch.setattr(queries, "stream_session", many_files)
    day = F.timestamp_seconds(F.lit(1_600_000_000 // 86400 * 86400) + F.col("id") * 7919 % 40 * 86400)
    orders = spark.range(400).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(10.5).alias("o_totalprice"), day.cast("timestamp_ntz").alias("o_orderdate"),
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    lines = spark.range(1200).select(
        (F.col("id") % 400).alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 3 + 3).cast("int").alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"), F.lit(3.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = queries._stream_orders("second")(spark, str(tmp_path)).select("order_id", "detail_id").collect()
    assert sorted((r.order_id, r.detail_id) for r in rows) == sorted((k % 400, k % 400 * 8 + k % 3 + 3) for k in range(1200))


def test_order_stream_equals_batch(spark, streams, feed, tmp_path):
    random.seed(2)
    def at(s):
        return f"2021-01-01 00:{s // 60:02}:{s % 60:02}"
    info = [{"id": i, "create_time": at(10 * i)} for i in range(40)]
    lines = [{"id": 100 + i, "order_id": i % 40, "create_time": at(max(0, 10 * (i % 40) + random.randrange(-8, 9)))} for i in range(80)]
    lines.sort(key=lambda r: r["create_time"])
    source = feed(names.ORDER_INFO, info[:20], info[20:])
    feed(names.ORDER_DETAIL, lines[:40], lines[40:])
    for grain in ("second", "day"):
        wide = order_plan.stream_order_wide(streams, source, grain, delay="5 minutes")
        writer = wide.writeStream.option("checkpointLocation", str(tmp_path / f"state-{grain}")).trigger(availableNow=True)
        writer.format("parquet").start(str(tmp_path / grain)).awaitTermination()
        got = sorted((r.order_id, r.detail_id) for r in spark.read.parquet(str(tmp_path / grain)).collect())
        want = sorted((r.order_id, r.detail_id) for r in order_plan.run_order_wide(spark, source, grain)[0].collect())
        assert got == want and got


def test_rejected_orders_are_kept(spark, streams, feed, tmp_path):
    source = feed(names.ORDER_INFO, [{"id": 1, "create_time": "2021-01-01 00:00:00"}, "bad", {"id": 2}])
    feed(names.ORDER_DETAIL, [{"id": 5, "order_id": 1, "create_time": "2021-01-01 00:00:01"}, {"id": 6}])
    wide, rejected = order_plan.run_order_wide(spark, source)
    want = [("bad_json", names.ORDER_INFO), ("no_create_time", names.ORDER_INFO), ("no_key", names.ORDER_DETAIL)]
    assert wide.count() == 1
    assert sorted((r["reject_reason"], r["source"]) for r in (json.loads(r.value) for r in rejected.collect())) == want
    query = order_plan.stream_rejected_orders(streams, source).writeStream.format("memory").queryName("rejected_orders")
    query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert streams.table("rejected_orders").count() == 3


def test_rough_records_pass_the_log_stream(spark, streams, feed, tmp_path):
    rough = [
        '{"common":{"mid":"a","is_new":"1"},"page":{"page_id":"p","x":1,"x":2},"ts":%d}' % ts for ts in (0, DAY_MS)
    ] + ["{'common':{'mid':'a','is_new':'1'},'page':{'page_id':'q'},'ts':%d}" % (2 * DAY_MS)]
    rough += [json.dumps(log("a", 3 * DAY_MS, displays=[])).replace('"displays": []', '"displays":[{"i":1,"i":2}]')]
    source, target = feed(names.ODS_LOG, rough), FolderTopics(str(tmp_path / "out"))
    log_plan.start_logs(streams, source, target, str(tmp_path / "state"), once=True).awaitTermination()
    batch = logs.repair_is_new(accepted(logs.parse_log(read_topic(spark, source, names.ODS_LOG))))
    for rows in (out(spark, target, names.PAGE_LOG), batch.collect()):
        flags = {r.arrival: r.value for r in rows}
        assert sorted(flags) == [0, 1, 2, 3] and None not in flags.values()
        assert '"1"' in flags[0] and '"0"' in flags[1] and "\'1\'" not in flags[2]
    assert [json.loads(r.value) for r in out(spark, target, names.DISPLAY_LOG)] == [{"i": 2, "page_id": "home"}]


class Store:
    """What a day-change processor asks of its state."""

    def __init__(self):
        self.held, self.writes = {}, 0

    def getMapState(self, *_):
        return self

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key], self.writes = value, self.writes + 1


def test_expiry_is_renewed_by_each_opening():
    store = Store()
    change = processors.DayChange(DAY_MS)
    change.init(store)
    rows = pd.DataFrame([{"mid": m, "value": "v", "arrival": i, "day": d} for i, (m, d) in enumerate([("a", "d1"), ("a", "d2"), ("a", "d1"), ("b", "d9")])])
    assert len(next(change.handleInputRows((0,), iter([rows[:1]]), None))) == 1
    assert len(next(change.handleInputRows((0,), iter([rows[1:]]), None))) == 3
    assert store.held == {("a",): ("d1",), ("b",): ("d9",)} and store.writes == 3


class CountedMap:
    """A state map that counts how often it is asked."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value

    def containsKey(self, key):
        self.calls += 1
        return key in self.held

    def removeKey(self, key):
        self.calls += 1
        del self.held[key]

    def keys(self):
        self.calls += len(self.held)
        return iter(list(self.held))


class Handle:
    def __init__(self):
        self.map, self.timers = CountedMap(), set()

    def getMapState(self, *_):
        return self.map

    def registerTimer(self, at):
        self.timers.add(at)


class Timers:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    def getExpiryTimeInMs(self):
        return self.at


def test_a_day_of_many_devices_is_a_few_entries_of_state():
    handle, first = Handle(), processors.FirstOfDay()
    first.init(handle)

    def taken(mids, watermark=0):
        rows = pd.DataFrame({"shard": 0, "mid": mids, "value": "v", "arrival": range(len(mids)), "day": "d", "day_end": DAY_MS})
        rows["part"] = [int(m) % 4 for m in mids]
        return [(kind, mid) for kind, mid in next(iter(first.handleInputRows((0,), iter([rows]), Timers(watermark))))[["kind", "mid"]].values]

    old, new = [str(i) for i in range(1000)], [str(i) for i in range(900, 1500)]
    assert taken(old + old) == [("kept", m) for m in sorted(old)]
    assert taken(new) == [("kept", m) for m in sorted(new[100:])]
    assert handle.timers == {DAY_MS}
    list(first.handleExpiredTimer((0,), Timers(DAY_MS), Timers(DAY_MS)))
    assert not handle.map.held and handle.map.calls <= 6 * 4
    assert taken(["1"], DAY_MS) == [("late", "1")]

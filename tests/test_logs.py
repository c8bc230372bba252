import json

from pyspark.sql import functions as F

from conftest import log
from shopstream import names
from shopstream.functions.times import DAY_MS
from shopstream.operators.logs import explode_displays, log_records, parse_log, repair_is_new, split_logs
from shopstream.operators.rejects import accepted, quarantined
from shopstream.operators.skew import Skew


def flags(df):
    return {r.arrival: (r.f, json.loads(r.value)["common"]["is_new"]) for r in df.select("arrival", F.col("common.is_new").alias("f"), "value").collect()}


def test_bad_logs_are_quarantined_with_a_reason(topic):
    raw = topic(
        "no json", {"page": {"page_id": "a"}, "ts": 1}, {"common": {"is_new": "0"}, "page": {}, "ts": 1},
        {"common": {"mid": "1"}, "ts": 1}, log(is_new="1", ts=None), None, "[1]", log(displays=[None]),
        log(start={}), log(is_new=0, displays=[]), log(ts=None), log(ts="5"),
    )
    parsed = parse_log(raw)
    reasons = {r.arrival: r.reject_reason for r in quarantined(parsed).collect()}
    assert reasons == {
        0: "bad_json", 1: "no_common", 2: "no_mid", 3: "no_page", 4: "no_ts", 5: "bad_json", 6: "bad_json", 7: "bad_display",
    }
    assert {r.arrival: r.ts for r in accepted(parsed).collect()} == {8: 0, 9: 0, 10: None, 11: 5}


def test_only_flagged_rows_decide_the_first_day_in_arrival_order(topic):
    day2, day1 = 5 * DAY_MS, 4 * DAY_MS
    raw = topic(
        log("a", day1, is_new="0"), log("a", day2, is_new="1"), log("a", day2 + 5, is_new=1), log("a", day1, is_new="1"),
        log("b", day1, is_new="1"), log("b", day2, is_new="0"),
    )
    got = flags(repair_is_new(accepted(parse_log(raw))))
    assert got[0] == ("0", "0")
    assert got[1] == ("1", "1") and got[2][0] == "1"
    # An earlier date that arrives later is not the first day.
    assert got[3] == ("0", "0")
    assert got[4] == ("1", "1") and got[5] == ("0", "0")


def test_repaired_text_keeps_all_other_fields(topic):
    extra = {"vc": "v2.1", "n": 3, "deep": {"a": [1, {"b": 'q"uote'}]}}
    raw = topic(log("a", 0, is_new="1"), {**log("a", DAY_MS, is_new="1"), "err": extra})
    text = {r.arrival: json.loads(r.value) for r in repair_is_new(accepted(parse_log(raw))).collect()}
    assert text[1] == {**log("a", DAY_MS, is_new="0"), "err": extra}


def test_repair_with_hot_keys_gives_the_same(topic):
    raw = topic(*[log("ab"[i % 2], (i * 7 % 5) * DAY_MS, is_new="01"[i % 3 > 0]) for i in range(60)])
    logs = accepted(parse_log(raw))
    assert flags(repair_is_new(logs, skew=Skew(3))) == flags(repair_is_new(logs))


def test_split_into_start_page_and_display(topic):
    shown = [{"item": 1, "order": 2, "page_id": "old"}, {"item": "x", "note": None}]
    raw = topic(
        {"common": {"mid": "1"}, "start": {"entry": "icon"}, "displays": shown, "ts": 1},
        log(start={}, displays=shown), log(displays=[]),
    )
    split = split_logs(accepted(parse_log(raw)))
    assert [r.arrival for r in split.start.collect()] == [0]
    assert sorted(r.arrival for r in split.page.collect()) == [1, 2]
    # The page row is not stamped; its displays are, and hold nothing else of it.
    page = json.loads(split.page.where("arrival = 1").first().value)
    assert page["displays"] == shown
    displays = [json.loads(r.value) for r in split.display.orderBy("value").collect()]
    assert displays == [{"item": "x", "page_id": "home"}, {"item": 1, "order": 2, "page_id": "home"}]


def test_page_id_is_escaped_and_a_missing_one_removed(topic):
    raw = topic(log(page_id='a"\\b', displays=[{"i": 1}]), log(page_id=None, displays=[{"i": 1, "page_id": "x"}]))
    shown = explode_displays(accepted(parse_log(raw))).orderBy("arrival").collect()
    assert [json.loads(r.value) for r in shown] == [{"i": 1, "page_id": 'a"\\b'}, {"i": 1}]


def test_records_of_one_pass_equal_the_three_outputs(topic):
    raw = topic(
        log(displays=[{"i": 1}, {"i": 2}]), {"common": {"mid": "1"}, "start": {"a": "b"}, "ts": 1}, log(displays=[]), log()
    )
    logs = accepted(parse_log(raw))
    split = split_logs(logs)
    want = [(t, r.value) for t, df in zip((names.START_LOG, names.PAGE_LOG, names.DISPLAY_LOG), split) for r in df.collect()]
    assert sorted((r.topic, r.value) for r in log_records(logs).collect()) == sorted(want)
    assert len(want) == 6


def test_a_filter_on_the_reason_settles_no_repeated_keys(topic):
    plan = accepted(parse_log(topic(log(displays=[{"item": 1}])))).select("mid")._jdf.queryExecution().optimizedPlan().toString()
    assert "map_entries" not in plan

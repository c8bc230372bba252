import random

import pytest

from conftest import log
from shopstream.functions.times import DAY_MS
from shopstream.operators.logs import parse_log
from shopstream.operators.rejects import accepted
from shopstream.operators.visits import jump_detail, unique_visit


@pytest.fixture
def pages(topic):
    return lambda *records: accepted(parse_log(topic(*records)))


def arrivals(df):
    return sorted(r.arrival for r in df.select("arrival").collect())


def test_sample_bounce_is_device_101_only(pages):
    sample = pages(
        log("101", 10000), log("102", 12000), log("102", 15000, "good_list", "home"), log("102", 30000, "good_list", "detail")
    )
    assert [(r.mid, r.ts) for r in jump_detail(sample).collect()] == [("101", 10000)]


@pytest.mark.parametrize("gap,bounces", [(9_999, []), (10_000, [0]), (10_001, [0])])
def test_a_gap_of_exactly_ten_seconds_is_a_bounce(pages, gap, bounces):
    assert arrivals(jump_detail(pages(log(ts=0), log(ts=gap, last="home")))) == bounces


def test_any_next_page_cancels_the_bounce(pages):
    # A next page that is itself an entry, and one without an id.
    assert arrivals(jump_detail(pages(log(ts=0), log(ts=500), log(ts=900, page_id="", last="x")))) == []


def test_pages_at_the_same_time_follow_by_arrival(pages):
    assert arrivals(jump_detail(pages(log(ts=7), log(ts=7)))) == [1]


def test_unfinished_gaps_are_left_out_unless_complete(pages):
    logs = pages(log("a", 0), log("b", 10_000), log("c", 10_001), log("d", 20_001))
    assert arrivals(jump_detail(logs)) == [0, 1, 2, 3]
    assert arrivals(jump_detail(logs, complete=False)) == [0, 1]


def test_exact_visits_compare_with_the_last_stored_day(pages):
    days = pages(*[log(ts=d * DAY_MS) for d in (2, 1, 2, 2)])
    assert arrivals(unique_visit(days)) == [0, 1, 2]
    assert arrivals(unique_visit(days, "daily")) == [0, 1]


def test_pages_reached_from_another_page_do_not_count(pages):
    logs = pages(log(ts=0, last="x"), log(ts=1, last=""), log(ts=DAY_MS, last="x"), log(ts=DAY_MS + 1))
    assert arrivals(unique_visit(logs)) == [1, 3]


def test_counts_are_ordered(pages):
    random.seed(5)
    logs = pages(*[log(random.choice("ab"), random.randrange(4) * DAY_MS, last=random.choice(["", "x"])) for _ in range(80)])
    daily, exact = arrivals(unique_visit(logs, "daily")), arrivals(unique_visit(logs))
    assert len(daily) <= len(exact) <= 80 and set(daily) <= set(range(80))


def brute_jumps(records, gap):
    by_mid = {}
    for i, r in enumerate(records):
        by_mid.setdefault(r["common"]["mid"], []).append((r["ts"], i, not r["page"].get("last_page_id")))
    out = []
    for rows in by_mid.values():
        rows.sort()
        for (ts, i, entry), after in zip(rows, [*rows[1:], None]):
            if entry and (after is None or after[0] - ts >= gap):
                out.append(i)
    return sorted(out)


def brute_visits(records):
    last, out = {}, []
    for i, r in enumerate(records):
        mid, day = r["common"]["mid"], r["ts"] // DAY_MS
        if not r["page"].get("last_page_id") and last.get(mid) != day:
            last[mid] = day
            out.append(i)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_hot_devices_give_the_same_as_brute_force(pages, seed):
    random.seed(seed)
    # One device holds most rows; many of them at the same time.
    records = [
        log(random.choice("aaaabc"), random.choice([random.randrange(5), 2]) * (DAY_MS // 2), last=random.choice([None, "x"]))
        for _ in range(200)
    ]
    logs = pages(*records)
    assert arrivals(jump_detail(logs, DAY_MS // 2)) == brute_jumps(records, DAY_MS // 2)
    assert arrivals(unique_visit(logs)) == brute_visits(records)

import collections
import hashlib

import pytest

from shopstream.llm import grace

ROWS = "doc_id BIGINT, text STRING, row STRING, into STRING, copies INT"


def rough_texts():
    long = "word " * 40_000
    texts = [None, "", " \t\n", "a b", "ab", " a  b ", "é té", "été", " ", "x" * 300, long, long + " ", long.replace(" ", "")]
    rows = [(i, t, "r", "i", 1) for i, t in enumerate(texts)]
    rows += [(100 + i, "the very same text", "r", "i", 1) for i in range(400)] + [(90, "the very  same text", "r", "i", 1)]
    rows += [(1000 + i, f"text {i % 70} {'y' * (i % 7)}", "r", "i", 1) for i in range(300)]
    return rows + [(None, "a b", "r", "i", 1), (None, "nobody", "r", "i", 1), (7, "again", "", "", 1), (7, "again", "", "", 1)]


def plain(rows):
    """Each row's group; of rows alike in points and id, any one may be kept."""
    groups = collections.defaultdict(list)
    for doc_id, text, *_ in rows:
        groups["".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for text, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(text.encode()).hexdigest()
        left = [m for m in members]
        left.remove(best)
        out += [(best[3], best[3], len(members), True, sha)] + [(m[3], best[3], len(members), False, sha) for m in left]
    return sorted(map(str, out))


@pytest.mark.parametrize("how", [{}, {"buckets": 2, "table_bytes": 1500}, {"buckets": 1, "table_bytes": 500}])
def test_groups_equal_brute_force(spark, how):
    rows = rough_texts() if how.get("table_bytes") != 500 else rough_texts()[-60:]
    found = grace.exact_duplicates(spark.createDataFrame(rows, ROWS).repartition(5), **how)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(str(tuple(r)) for r in found.collect()) == plain(rows)


def test_empty_table(spark):
    assert grace.exact_duplicates(spark.createDataFrame([], ROWS)).count() == 0


def test_ids_may_be_texts(spark):
    rows = [("b", "x y"), ("a", "xy"), ("c", "x y")]
    found = grace.exact_duplicates(spark.createDataFrame(rows, "doc_id STRING, text STRING")).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in found} == {("a", "b", False), ("b", "b", True), ("c", "b", False)}


def test_table_compares_contents_and_takes_all_copies_or_none():
    table = grace.Table(3 * grace.ENTRY_BYTES + 10)
    assert [table.place(5, b"a"), table.place(5, b"b"), table.place(5 + 64, b"c")] == [0, 1, 2]
    assert table.place(5, b"d") == -1 and table.place(5, b"b") == 1 and table.place(5 + 64, b"c") == 2


def test_table_grows():
    table = grace.Table(1 << 30)
    marks = [hash(str(i)) % (1 << 40) - (1 << 39) for i in range(5000)]
    assert [table.place(m, b"%d" % i) for i, m in enumerate(marks)] == list(range(5000))
    assert [table.place(m, b"%d" % i) for i, m in enumerate(marks)] == list(range(5000))


def test_copies_are_brought_down_before_they_are_dealt(spark):
    rows = [(i, "hot text" if i % 3 else f"own {i}", "", "", 1) for i in range(900)]
    found = grace.exact_duplicates(spark.createDataFrame(rows, ROWS).repartition(4))
    hot = found.where("group_size = 600")
    assert hot.count() == 600 and hot.where("kept").collect()[0]["doc_id"] == 1

import hashlib

import pytest

from shopstream.llm import warc

V = warc.VERSION
FAKE = f"x{V}WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 10\r\n\r\n0123456789\r\n\r\n"
PAGES = "page_id BIGINT, url STRING, html STRING, payload STRING, digest INT"


def rough_pages():
    rows = [(i, f"http://a/{i}", f"p{i} " * (i * 37 % 900)) for i in range(40)]
    rows += [(100, "u", FAKE * 3), (101, None, FAKE + "é" * 3000 + FAKE), (102, "u", V * 2000), (103, "u", None), (104, "u", "")]
    rows += [(105, "u", "same" * 400), (106, "u", "same" * 400), (107, "u", "same" * 400), (None, "u", "same" * 400)]
    rows += [(120, "u", "short"), (121, "u", "short"), (122, "u", "a" * 1000), (123, "u", "a" * 1000), (124, "u", "b" * 999), (125, "u", "b" * 999)]
    rows += [(108, "u\r\nContent-Length: 3", V), (None, "n", "y"), (109, "u", "\r\n\r\n" + V[:-1]), (110, "u", V[:4])]
    # A false record that ends just where the true one does, and a very long payload.
    return rows + [(112, "u", f"{V}Content-Length: 5\r\n\r\n12345"), (113, "u", "A" * 90000 + V + "B" * 90000)]


def expected(rows):
    kept = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            kept[h] = max(kept.get(h, i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        refers = kept.get(h) if len(data) >= 1000 and kept.get(h) != i else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(map(str, out))


def read(found):
    page = warc.page_of
    rows = found.select(
        page(warc.F.col("record_id")), "payload_bytes", "payload_digest", "record_type", page(warc.F.col("refers_to")),
    ).collect()
    return sorted(str(tuple(r)) for r in rows)


@pytest.mark.parametrize("split", ["3000", "64m"])
def test_archives_give_back_what_was_written(spark, split):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rough_pages()], PAGES).repartition(3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert read(warc.round_trip(pages)) == expected(rough_pages())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_pieces_are_found_again_where_a_reading_is_split_otherwise(spark, monkeypatch):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rough_pages()], PAGES).repartition(3)
    reachable = warc.reachable

    def resplit(found):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1700")
        return reachable(found)

    monkeypatch.setattr(warc, "reachable", resplit)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert read(warc.round_trip(pages)) == expected(rough_pages())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_foreign_archives(spark, tmp_path):
    def record(page, payload, extra=""):
        body = b"HTTP/1.1 200 OK\r\n\r\n" + payload
        head = f"{V}warc-record-id: <urn:page:{page}>\r\nWARC-Type: response\r\n{extra}content-length: {len(body)}\r\n\r\n"
        return head.encode() + body + b"\r\n\r\n"

    binary = bytes(range(256)) * 20 + V.encode() + b"\xff\xfe"
    (tmp_path / "a.warc").write_bytes(record(1, binary) + record(2, b""))
    # After a cut record nothing can be reached.
    (tmp_path / "b.warc").write_bytes(record(3, b"three") + record(4, b"four" * 9)[:-30] + record(5, b"five"))
    found = {r["record_id"]: r for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert found["<urn:page:1>"]["payload_digest"] == hashlib.sha1(binary).hexdigest()
    assert found["<urn:page:2>"]["payload_bytes"] == 0 and "<urn:page:3>" in found and "<urn:page:5>" not in found


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0

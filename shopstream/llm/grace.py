"""Exact duplicates by Grace hashing.

Rows are dealt to buckets by a hash of their text, and each bucket is taken in by
an open-addressing table that compares complete texts. Texts that a full table
has no room for are spilled to files and dealt again, by another hash, until
every bucket fits. A table takes a text's first copy or none of its copies, so a
text is never in two places.

Before they are dealt, a table in each task brings the copies it meets down to
one row with their number and the best of them, so that a text with any share of
all rows reaches its bucket once a task; its other rows go on without text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import staged

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
TABLE_BYTES = 64 << 20
ENTRY_BYTES = 200
BATCH_ROWS = 10_000
BATCH_BYTES = 8 << 20


class Table:
    """An open-addressing table of contents, probed in a line, with room for ``max_bytes`` or one content."""

    def __init__(self, max_bytes: int):
        self.max_bytes, self.bytes = max_bytes, 0
        self.slots = [-1] * 64
        self.marks: list[int] = []
        self.contents: list[bytes] = []

    def place(self, mark: int, content: bytes) -> int:
        """The number of the entry with this content, a new one if there is room; -1 if there is none."""
        slots, mask = self.slots, len(self.slots) - 1
        at = mark & mask
        while (entry := slots[at]) >= 0:
            if self.marks[entry] == mark and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        size = len(content) + ENTRY_BYTES
        if self.contents and self.bytes + size > self.max_bytes:
            return -1
        self.bytes += size
        slots[at] = len(self.contents)
        self.marks.append(mark)
        self.contents.append(content)
        if 2 * len(self.contents) > len(slots):
            self._grow()
        return len(self.contents) - 1

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, mark in enumerate(self.marks):
            at = mark & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def better(a: tuple, b: tuple) -> tuple:
    """Of two (points, id, row): more points, then the smaller id, one without id last, then the smaller row."""
    return min(a, b, key=lambda x: (-x[0], x[1] is None, 0 if x[1] is None else x[1], x[2]))


# -- passes ------------------------------------------------------------------

# A copy has ``into``, the row that stands for it. A text on its way has ``text``, the copies so far and the best of
# them. A text that is done has ``sha``.
COLUMNS = ["row", "id", "into", "points", "keep_id", "keep_row", "copies", "mark", "sha", "text"]


def _schema(id_type: pa.DataType) -> pa.Schema:
    kinds = {"id": id_type, "keep_id": id_type, "sha": pa.string(), "text": pa.binary()}
    return pa.schema([(c, kinds.get(c, pa.int64())) for c in COLUMNS])


class Batches:
    """Rows gathered to batches of bounded rows and bytes."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, **row: object) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += len(row.get("text") or b"")
        if len(self.rows) >= BATCH_ROWS or self.bytes >= BATCH_BYTES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array([r.get(f.name) for r in self.rows], f.type) for f in self.schema]
            self.rows, self.bytes = [], 0
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _before_dealing(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Documents (row, id, points, text) to texts on their way and copies of them."""
    table, classes, out = Table(max_bytes), [], None
    for batch in batches:
        out = out or Batches(_schema(batch.schema.field("id").type))
        columns = [batch.column(c).to_pylist() for c in ("row", "id", "points")]
        for i, (row, own, points) in enumerate(zip(*columns)):
            content = (batch.column("text")[i].as_py() or b"").translate(None, BLANKS)
            mark = xxhash.xxh64_intdigest(content) - (1 << 63)
            entry = table.place(mark, content)
            if entry < 0:
                yield from out.add(row=row, id=own, points=points, keep_id=own, keep_row=row, copies=1, mark=mark, text=content)
            elif entry == len(classes):
                classes.append([row, own, 1, (points, own, row)])
            else:
                found = classes[entry]
                found[2:] = [found[2] + 1, better(found[3], (points, own, row))]
                yield from out.add(row=row, id=own, into=found[0])
    for (row, own, copies, best), mark, content in zip(classes, table.marks, table.contents):
        yield from out.add(row=row, id=own, points=best[0], keep_id=best[1], keep_row=best[2], copies=copies, mark=mark, text=content)
    if out:
        yield from out.rest()


def _in_bucket(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """A bucket's texts through one table: those that it holds are done, the others come out as they went in."""
    table, members, totals, out = Table(max_bytes), [], [], None
    for batch in batches:
        out = out or Batches(_schema(batch.schema.field("id").type))
        batch = pa.RecordBatch.from_arrays(batch.columns, schema=out.schema)
        yield batch.filter(pc.is_valid(batch.column("into")))
        waiting = batch.filter(pc.is_valid(batch.column("text")))
        narrow = waiting.drop_columns(["text", "sha", "into"]).to_pylist()
        for i, row in enumerate(narrow):
            content = waiting.column("text")[i].as_py()
            entry = table.place(row["mark"], content)
            best = (row["points"], row["keep_id"], row["keep_row"])
            if entry < 0:
                yield from out.add(**row, text=content)
            elif entry == len(members):
                members.append([(row["row"], row["id"])])
                totals.append((row["copies"], best))
            else:
                members[entry].append((row["row"], row["id"]))
                totals[entry] = (totals[entry][0] + row["copies"], better(totals[entry][1], best))
    for rows, (copies, best), content in zip(members, totals, table.contents):
        sha = hashlib.sha256(content).hexdigest()
        for row, own in rows:
            yield from out.add(row=row, id=own, keep_id=best[1], keep_row=best[2], copies=copies, sha=sha)
    if out:
        yield from out.rest()


# -- tables ------------------------------------------------------------------


def _deal(level: int) -> Column:
    """Texts by their hash, with another seed on each level; copies, which need no company, by their row."""
    return F.when(F.col("into").isNull(), F.xxhash64("mark", F.lit(level))).otherwise(F.xxhash64("row"))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES, buckets: int | None = None,
) -> DataFrame:
    """``(<id_col>, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    Texts are equal when they are after all ASCII white space is deleted; null
    counts as empty. Of equal texts that with the most code points stays, then
    that with the smallest id, rows without an id last; of rows alike in all of
    this, one. ``text_sha256`` is that of the text without white space. Other
    columns are left out, whatever their names. ``buckets`` are those of the first
    dealing; by default as many as half fill their tables, and no fewer than
    ``spark.sql.shuffle.partitions``.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    kinds = {"id": id_type, "keep_id": id_type, "sha": "string", "text": "binary"}
    schema = ", ".join(f"{c} {kinds.get(c, 'bigint')}" for c in COLUMNS)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.coalesce(F.length(text_col), F.lit(0)).cast("bigint").alias("points"), F.col(text_col).cast("binary").alias("text"),
    )
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def wanted(texts: DataFrame) -> tuple[int, int]:
        """How many rows these texts are, and how many buckets they need."""
        count, size = texts.agg(F.count(F.lit(1)), F.sum(F.octet_length("text") + ENTRY_BYTES)).first()
        return count, max(least, -(-2 * (size or 0) // table_bytes))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _before_dealing(batches, table_bytes)

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_bucket(batches, table_bytes)

    moving, level, through = rows.mapInArrow(local, schema), 0, []
    number = buckets or wanted(rows)[1]
    while number:
        through.append(staged(moving.repartition(number, _deal(level)).mapInArrow(bucket, schema)))
        moving, level = through[-1].where("text IS NOT NULL"), level + 1
        left, number = wanted(moving.select("text"))
        number = number if left else 0
    copies = through[0].where("into IS NOT NULL").select("row", "id", "into")
    done = through[0].where("sha IS NOT NULL")
    for more in through[1:]:
        done = done.union(more.where("sha IS NOT NULL"))
    results = done.select("row", "id", "keep_id", "keep_row", "copies", "sha")
    of_copies = copies.join(results.drop("id").withColumnRenamed("row", "into"), "into").select(*results.columns)
    return results.union(of_copies).select(
        F.col("id").alias(id_col), "keep_id", F.col("copies").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"),
    )

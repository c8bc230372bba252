"""WARC archives, written and read by Spark; record boundaries verified as chains.

Archives are read in splits, cut at every occurrence of the version line, also
those inside payloads. Each piece is a candidate record: its header says where
its successor must start. Candidates that follow one another inside a split are
joined to runs, and pointer jumping over the runs, from the start of each file,
keeps only the records that a chain of lengths reaches. What looked like a
record inside a payload is part of that payload again.

Windows span a split of a file at most. Payloads are read and hashed where they
lie; only those that a false boundary cut in pieces are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstream.llm.common import checkpointed, staged, work_dir

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
REVISIT_BYTES = 1000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"


# -- writing -----------------------------------------------------------------


def _payload(column: str) -> Column:
    return F.coalesce(F.col(column).cast("binary"), F.lit("").cast("binary"))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines, without those whose value is null."""
    return F.concat_ws("\r\n", *[F.concat(F.lit(f"{name}: "), value) for name, value in pairs])


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{ID}"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int = REVISIT_BYTES) -> DataFrame:
    """One record text per page, in column ``value``, without the blank lines after it.

    Of pages with equal payloads of at least ``least`` bytes the one with the
    largest id is the response, and others revisit it; rows that repeat that id
    are responses too, as are all if no id of theirs is known.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"), F.regexp_replace(F.col(url_col).cast("string"), "[\\r\\n]+", "%0A").alias("url"),
        _payload(payload_col).alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload")})
    kept = staged(
        rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.max("id").alias("kept"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND kept IS NOT NULL").drop("n")
    )
    named = rows.join(kept, "digest", "left")
    revisit = (F.col("bytes") >= least) & F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END),
    )
    head = _lines(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", _record_id(F.col("id"))),
        ("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(revisit, _record_id(F.col("kept")))), ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string")),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    return named.select(F.concat(F.lit(VERSION), head, F.lit(END), http, body).alias("value"))


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least: int = REVISIT_BYTES,
) -> None:
    """Uncompressed archives in ``folder``, one for each task. A null payload is an empty one; a null url is left out."""
    records(pages, id_col, url_col, payload_col, least).write.option("lineSep", END).text(folder)


# -- candidates --------------------------------------------------------------


def _field(head: Column, name: str) -> Column:
    return F.regexp_extract(head, f"(?:^|\r\n)(?i:{name}):[ \t]*([^\r\n]*)", 1)


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """What lies between version lines, with the place of each piece: file, split, and a number that ascends in the split."""
    return (
        spark.read.option("lineSep", VERSION).text(folder)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"), F.col("value").cast("binary").alias("piece"),
        )
    )


def _parsed(piece: Column) -> dict[str, Column]:
    """What a candidate's bytes say; ``length`` is null unless there is a whole header with a content length."""
    text = piece.cast("string")
    head = F.substring_index(text, END, 1)
    head_bytes = F.octet_length(head)
    length = F.when(head_bytes < F.octet_length(text), _field(head, "Content-Length").try_cast("bigint"))
    block = F.substring(piece, head_bytes + len(END) + 1, length.cast("int"))
    http_bytes = F.octet_length(F.substring_index(block.cast("string"), END, 1))
    payload = F.substring(block, http_bytes + len(END) + 1, F.octet_length(block))
    return {
        "length": length, "head_bytes": head_bytes,
        "whole": F.coalesce(F.octet_length(piece) >= head_bytes + len(END) + length, F.lit(False)),
        "type": _field(head, "WARC-Type"), "record": _field(head, "WARC-Record-ID"), "refers": _field(head, "WARC-Refers-To"),
        "said_digest": _field(head, "WARC-Payload-Digest"),
        "said_bytes": _field(F.substring_index(block.cast("string"), END, 1), "Content-Length").try_cast("bigint"),
        "digest": F.sha1(payload), "bytes": F.octet_length(payload).cast("bigint"),
    }


def _with_offset(found: DataFrame) -> DataFrame:
    """``found``, one row for each piece of one and the same reading, with the byte of the file at which its version line starts.

    Splits and numbers are those of a reading: another one may cut the files elsewhere. Offsets stay.
    """
    step = F.col("size") + len(VERSION)
    blocks = found.groupBy("file", "block").agg(F.sum(step).alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0))).drop("total")
    in_block = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("shift", F.coalesce(F.sum(step).over(in_block), F.lit(0))).join(blocks, ["file", "block"])
    # A piece starts behind its version line; the first of a file has none, being what comes before the first record.
    return placed.withColumn("offset", F.col("base") + F.col("shift") - len(VERSION)).drop("base", "shift")


def candidates(pieces: DataFrame) -> DataFrame:
    """A narrow row for each piece: place, offset in the file, the offset its successor must have, and its fields."""
    found = pieces.select("file", "block", "seq", F.octet_length("piece").alias("size"), "piece").select(
        "file", "block", "seq", "size", *[c.alias(n) for n, c in _parsed(F.col("piece")).items()],
    )
    placed = _with_offset(staged(found))
    following = F.col("offset") + len(VERSION) + F.col("head_bytes") + 2 * len(END) + F.col("length")
    return staged(placed.withColumn("next", following))


# -- chains ------------------------------------------------------------------


def reachable(found: DataFrame) -> DataFrame:
    """The candidates that the chain of lengths from the start of their file reaches.

    Runs are candidates of one split each of which ends where the next starts.
    Every run leaves for one place, so jumping doubles the distance each round.
    """
    order = Window.partitionBy("file", "block").orderBy("offset")
    heads = found.where(F.col("offset") >= 0).withColumn(
        "head", F.coalesce(F.lag("next").over(order) != F.col("offset"), F.lit(True)).cast("int"),
    )
    runs = checkpointed(
        heads.withColumn("run", F.sum("head").over(order)).select("file", "block", "run", "seq", "offset", "next")
    )
    exits = runs.groupBy("file", "block", "run").agg(F.max_by("next", "offset").alias("next"))
    node = F.struct("block", "run")
    entries = runs.select("file", F.col("offset").alias("next"), node.alias("to"))
    links = checkpointed(exits.where("next IS NOT NULL").select("file", node.alias("from"), "next").join(entries, ["file", "next"]))
    reached = checkpointed(runs.where("offset = 0").select("file", node.alias("at")))
    jumps, known = links.select("file", "from", "to"), reached.count()
    while True:
        further = reached.join(jumps.withColumnRenamed("from", "at"), ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = checkpointed(reached.union(further).distinct())
        now = reached.count()
        if now == known:
            break
        known = now
        ahead = jumps.select("file", F.col("from").alias("to"), F.col("to").alias("ahead"))
        jumps = checkpointed(jumps.join(ahead, ["file", "to"]).select("file", "from", F.col("ahead").alias("to")))
    entered = links.join(reached.withColumnRenamed("at", "from"), ["file", "from"]).select("file", "to", F.col("next").alias("entry"))
    entered = entered.union(runs.where("offset = 0").select("file", node, "offset"))
    entered = entered.groupBy("file", "to").agg(F.min("entry").alias("entry"))
    kept = runs.withColumn("to", node).join(entered, ["file", "to"]).where("offset >= entry").select("file", "block", "seq")
    return found.join(kept, ["file", "block", "seq"])


def _rejoined(spark: SparkSession, folder: str, found: DataFrame, kept: DataFrame) -> DataFrame:
    """The kept records that false boundaries cut, put together again and parsed. A group is one record.

    The files that hold such records are read once more, and what is read is
    written, so that its pieces and their offsets belong together; offsets then
    tell which pieces are meant, wherever this reading was split.
    """
    last = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owners = kept.select("file", F.col("offset").alias("own"), F.col("whole").alias("own_whole"))
    parts = staged(
        found.select("file", "offset").join(owners, (F.col("offset") == F.col("own")) & (found["file"] == owners["file"]), "left")
        .select(found["file"], "offset", F.when(F.col("own").isNotNull(), F.struct("own", "own_whole")).alias("owner"))
        .withColumn("owner", F.last("owner", True).over(last))
        .where("NOT owner.own_whole").select("file", "offset", F.col("owner.own").alias("owner"))
    )
    again = staged(_pieces(spark, folder).join(parts.select("file").distinct(), "file", "left_semi"))
    placed = _with_offset(again.select("file", "block", "seq", F.octet_length("piece").alias("size")))
    meant = placed.join(parts, ["file", "offset"]).select("file", "block", "seq", "offset", "owner")
    whole = (
        again.join(meant, ["file", "block", "seq"])
        .groupBy("file", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("parts"))
        .withColumn("piece", F.array_join(F.transform("parts", lambda p: F.hex(p["piece"])), "".join(f"{b:02X}" for b in VERSION.encode())))
        .withColumn("piece", F.unhex("piece"))
    )
    return whole.select(*[c.alias(n) for n, c in _parsed(F.col("piece")).items()])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``(record_id, record_type, payload_bytes, payload_digest, refers_to)`` of every record in the archives of a folder.

    Digests and sizes of responses are those of the payloads as read; a revisit,
    which holds no payload, tells those of the payload it stands for. Digests are
    lower-case hex. What no chain from a file's start reaches is no record.
    """
    found = candidates(_pieces(spark, folder))
    kept = checkpointed(reachable(found))
    read = kept.where("whole").select("type", "record", "refers", "said_digest", "said_bytes", "digest", "bytes")
    if kept.where("NOT whole").limit(1).count():
        read = read.unionByName(_rejoined(spark, folder, found, kept).select(read.columns))
    revisit = F.col("type") == "revisit"
    return read.select(
        F.col("record").alias("record_id"), F.col("type").alias("record_type"),
        F.when(revisit, F.col("said_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(revisit, F.lower(F.regexp_replace("said_digest", "^sha1:", ""))).otherwise(F.col("digest")).alias("payload_digest"),
        F.when(revisit, F.col("refers")).alias("refers_to"),
    )


def page_of(record_id: Column) -> Column:
    """The page id that a record id of :func:`write_archives` names; null for none."""
    return F.regexp_extract(record_id, f"^<{ID}(-?[0-9]+)>$", 1).try_cast("bigint")


def round_trip(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least: int = REVISIT_BYTES,
) -> DataFrame:
    """``pages`` written to archives in ``folder`` (one in the shared folder, unless given) and read back from there."""
    folder = folder or f"{work_dir(pages.sparkSession)}/warc"
    write_archives(pages, folder, id_col, url_col, payload_col, least)
    return read_archives(pages.sparkSession, folder)

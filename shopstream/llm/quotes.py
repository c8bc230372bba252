"""Chat formatting: messages that quote one another, linked to replies and freed of their quotes.

A quoted line begins with ``>`` marks, one for each level of nesting. A passage is
a run of lines of one level. Passages are normalised, blanks and line ends folded,
and hashed, and so are the lines of longer ones, as people cut quotes at lines and
mail programs wrap them anew. The hashes are joined to the earlier messages of the
conversation that say the same in their own words.

The message replied to is the one that says most passages of the outer quote, then
most of its lines, then the latest. Inner quotes link a quoted message to its own
parent where it doesn't quote one itself. Pointer doubling then finds the message
each thread starts with, and each message's depth.

Joins are on conversation and hash, so one hot conversation is spread by what is
said in it. What very many messages say is no danger either: a message's most
common quote is not met with all who say it, but with the latest alone, since one
who says nothing else of the quote can only win by being the latest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import checkpointed, staged
from shopstream.operators.ordered import with_latest

MARKS = "^((?:>[ \\t]?)+)"


# -- lines -------------------------------------------------------------------


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\r?\n")


def quote_level(line: Column) -> Column:
    """How many ``>`` marks a line begins with, blanks between them allowed."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def folded(lines: Column) -> Column:
    """Lines without marks, in lower case and with single blanks, as one text."""
    plain = F.array_join(F.transform(lines, lambda x: F.regexp_replace(x, MARKS, "")), " ")
    return F.lower(F.trim(F.regexp_replace(plain, "[\\x20\\x09-\\x0D]+", " ")))


def _runs(messages: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """The passages of texts: ``keep`` and a ``run`` of ``level`` and ``lines``, for each run of lines of one level.

    Lines without words are of no account. Each step is a column of its own behind
    a generator, so that what it needs is there once and not for every line.
    """
    levelled = F.transform(_lines(text), lambda x: F.struct(quote_level(x).alias("level"), folded(F.array(x)).alias("line")))
    first = messages.select(*keep, F.explode(F.array(levelled)).alias("all"))
    names = first.columns[:-1]
    starts = F.filter(
        F.sequence(F.lit(1), F.size("all")),
        lambda i: (i == 1) | (F.col("all")[i - 1]["level"] != F.col("all")[F.greatest(i - 2, F.lit(0))]["level"]),
    )
    second = first.select(*names, "all", F.explode(F.array(starts)).alias("starts"))

    def run(start: Column, place: Column) -> Column:
        until = F.coalesce(F.get("starts", place + 1), F.size("all") + 1)
        lines = F.transform(F.slice("all", start, until - start), lambda x: x["line"])
        return F.struct(F.col("all")[start - 1]["level"].alias("level"), F.filter(lines, lambda x: x != "").alias("lines"))

    return second.select(*names, F.explode(F.transform("starts", run)).alias("run")).where(F.size("run.lines") > 0)


def own_words(text: Column) -> Column:
    """A text without its quoted lines; empty for null."""
    return F.array_join(F.filter(_lines(text), lambda x: ~x.startswith(">")), "\n")


# -- links -------------------------------------------------------------------


def passages(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """``(conv, turn, level, hash, passages, lines)``: what each message says and quotes, once for each level, in a written table.

    ``passages`` and ``lines`` count how often the hash is a whole passage of the
    level, and one of its lines. Messages without conversation or turn have none.
    """
    placed = messages.where(F.col(conv_col).isNotNull() & F.col(turn_col).isNotNull())
    runs = _runs(placed, F.col(text_col), F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"))
    single = F.size("run.lines") == 1
    lines = F.transform("run.lines", lambda x: F.struct(x.alias("text"), single.cast("int").alias("passage"), F.lit(1).alias("line")))
    whole = F.array(F.struct(F.array_join("run.lines", " ").alias("text"), F.lit(1).alias("passage"), F.lit(0).alias("line")))
    said = runs.select("conv", "turn", "run.level", F.explode(F.when(single, lines).otherwise(F.concat(whole, lines))).alias("said"))
    return staged(
        said.groupBy("conv", "turn", "level", F.xxhash64("said.text").alias("hash"))
        .agg(F.sum("said.passage").alias("passages"), F.sum("said.line").alias("lines"))
    )


def quoted_messages(found: DataFrame) -> DataFrame:
    """``(conv, turn, level, original)``: the earlier message that the quote of a level comes from, if one is known."""
    key = ["conv", "hash"]
    said = staged(found.where("level = 0").select(*key, F.col("turn").alias("by")))  # once for each message
    units = found.where("level > 0")
    often = said.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    # Each quote with the latest message before it that says the same; a quote that nobody says is of no use.
    latest = with_latest(units.withColumn("before", F.col("turn") - 1), said.withColumn("at", F.col("by")), key, "before", "at", "latest")
    known = staged(latest.where("latest IS NOT NULL").join(often, key).select(*units.columns, "latest.by", "n"))
    message = ["conv", "turn", "level"]
    most = known.groupBy(*message).agg(F.max(F.struct("n", "hash")).alias("most"))
    rest = known.join(most, message).where("hash <> most.hash").select(*message, "hash")
    met = rest.join(said, key).where("by < turn").select(*message, "by")
    candidates = staged(known.select(*message, "by").union(met).distinct())
    matched = candidates.join(known.select(*message, "hash", "passages", "lines"), message).join(said, [*key, "by"])
    scored = matched.groupBy(*message, "by").agg(F.sum("passages").alias("passages"), F.sum("lines").alias("lines"))
    return scored.groupBy(*message).agg(F.max_by("by", F.struct("passages", "lines", "by")).alias("original"))


def quoted_lines(found: DataFrame) -> DataFrame:
    """``(conv, turn, quoted)``: how many quoted lines, of any level, an earlier message says."""
    first = found.where("level = 0").groupBy("conv", "hash").agg(F.min("turn").alias("first"))
    known = found.where("level > 0 AND lines > 0").join(first, ["conv", "hash"]).where("first < turn")
    return known.groupBy("conv", "turn").agg(F.sum("lines").alias("quoted"))


def replied_to(originals: DataFrame) -> DataFrame:
    """``(conv, turn, parent)``: the message the outer quote comes from.

    For a message without one, what its own quoters say by quoting on: the source
    of a quote one level further in, that most of them name, the latest of equals.
    """
    direct = originals.where("level = 1").select("conv", "turn", F.col("original").alias("parent"))
    outer = originals.select("conv", "turn", (F.col("level") + 1).alias("level"), F.col("original").alias("quoted"))
    inner = originals.join(outer, ["conv", "turn", "level"]).where("original < quoted")
    votes = inner.groupBy("conv", F.col("quoted").alias("turn"), "original").agg(F.count(F.lit(1)).alias("n"))
    told = votes.groupBy("conv", "turn").agg(F.max_by("original", F.struct("n", "original")).alias("told"))
    return direct.join(told, ["conv", "turn"], "full_outer").select("conv", "turn", F.coalesce("parent", "told").alias("parent"))


def threads(parents: DataFrame) -> DataFrame:
    """``(conv, turn, parent, root, depth)`` from ``(conv, turn, parent)``, one row per message; parents are earlier turns."""
    state = checkpointed(parents.select(
        "conv", "turn", "parent", F.coalesce("parent", "turn").alias("root"), F.col("parent").isNotNull().cast("int").alias("depth"),
        F.col("parent").isNull().alias("done"),
    ))
    while state.where("NOT done").limit(1).count():
        above = state.select(
            "conv", F.col("turn").alias("root"), F.col("root").alias("top"), F.col("depth").alias("more"), F.col("done").alias("settled"),
        )
        # Only messages whose root is not known yet are looked up again: each round, those twice as deep as before.
        moved = state.where("NOT done").join(above, ["conv", "root"], "left").select(
            "conv", "turn", "parent", F.coalesce("top", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("settled", F.lit(True)).alias("done"),
        )
        state = checkpointed(state.where("done").unionByName(moved))
    return state.drop("done")


def reply_conversations(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text",
) -> DataFrame:
    """``messages`` with ``parent``, ``root``, ``depth`` and ``quoted`` added or replaced, and quotes taken out of the text.

    Ordered by conversation, ``root`` and turn, every message comes after the one
    it replies to. ``parent`` is null for a message that quotes none before it, as
    far as is known; it is its own root, of depth 0. ``quoted`` counts quoted lines
    that an earlier message says, of any level. Messages without a conversation or
    turn are kept, with a null root. Rows that share conversation and turn are one
    message in the links, and each stays a row. Turns are whole numbers. A text of
    any length is one value of its row, worked on line by line.
    """
    found = passages(messages, conv_col, turn_col, text_col)
    known = messages.where(F.col(conv_col).isNotNull() & F.col(turn_col).isNotNull()).select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
    ).distinct()
    originals = staged(quoted_messages(found))
    placed = threads(known.join(replied_to(originals), ["conv", "turn"], "left"))
    facts = staged(placed.join(quoted_lines(found), ["conv", "turn"], "left"))
    rows = messages.select(
        F.struct(*messages.columns).alias("message"), F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
    ).join(facts, ["conv", "turn"], "left")
    added = {
        text_col: own_words(F.col(f"message.{text_col}")), "parent": F.col("parent"), "root": F.col("root"),
        "depth": F.coalesce("depth", F.lit(0)), "quoted": F.coalesce("quoted", F.lit(0)),
    }
    kept = [F.col(f"message.{c}").alias(c) for c in messages.columns if c not in added]
    return rows.select(*kept, *[c.alias(name) for name, c in added.items()])


def as_mails(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """Plain turns as mails: each quotes the turn before it, and inside that quote the one before that.

    Of rows that share conversation and turn, which say different things, the
    smallest text is quoted. A turn with nothing before it quotes nothing.
    """
    texts = messages.groupBy(F.col(conv_col).alias("conv"), F.col(turn_col).alias("at")).agg(F.min(text_col).alias("said"))

    def marked(text: Column, marks: str) -> Column:
        lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.concat(F.lit(marks), x))
        return F.when(text.isNotNull(), F.array_join(lines, "\n"))

    rows = messages.select(F.struct(*messages.columns).alias("message"), F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"))
    for back in (1, 2):
        before = texts.select("conv", (F.col("at") + back).alias("turn"), F.col("said").alias(f"said{back}"))
        rows = rows.join(before, ["conv", "turn"], "left")
    mail = F.concat_ws("\n", marked(F.col("said2"), ">> "), marked(F.col("said1"), "> "), F.coalesce(f"message.{text_col}", F.lit("")))
    return rows.select(*[F.col(f"message.{c}").alias(c) for c in messages.columns if c != text_col], mail.alias(text_col))

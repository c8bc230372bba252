import collections
import random
import re

import pytest

from shopstream.llm import quotes

MESSAGES = "conv_id BIGINT, turn BIGINT, text STRING, root STRING, extra INT"


def test_replies_are_linked_and_freed_of_quotes(spark):
    rows = [
        (1, 0, "Shall we meet?\nAt  Noon.", "", 0),
        (1, 1, "> shall we   meet?\nYes.", "", 0),
        (1, 2, "No quote here", "", 0),
        (1, 3, ">> Shall we meet?\n>At noon.\n> yes.\n> YES.\nGood.\r\n>> nothing known", "", 0),
        (1, 4, "> > At noon.\n> Good.\n", "", 0),
        (2, 0, "Yes.", "", 0), (2, 1, "> Shall we meet?\nother", "", 0), (2, 2, None, "", 0), (2, 3, "", "", 0), (2, 4, ">", "", 0),
        (None, 1, "> Yes.\nlost", "", 0), (3, None, "> a\nb", "", 0), (1, 1, "> shall we   meet?\nYes.", "", 0),
    ]
    found = quotes.reply_conversations(spark.createDataFrame(rows, MESSAGES)).collect()
    assert len(found) == len(rows)
    got = {(r["conv_id"], r["turn"]): (r["text"], r["parent"], r["root"], r["depth"], r["quoted"]) for r in found}
    assert got[1, 0] == ("Shall we meet?\nAt  Noon.", None, 0, 0, 0)
    assert got[1, 1] == ("Yes.", 0, 0, 1, 2)  # the line counts for each row of the repeated message
    assert got[1, 2] == ("No quote here", None, 2, 0, 0)
    assert got[1, 3] == ("Good.", 1, 0, 2, 4)  # "at noon" is of turn 0, "yes" twice of turn 1
    assert got[1, 4] == ("", 3, 0, 3, 2)
    assert got[2, 1] == ("other", None, 1, 0, 0) and got[2, 2][0] == "" and got[2, 4] == ("", None, 4, 0, 0)
    assert got[None, 1] == ("lost", None, None, 0, 0) and got[3, None] == ("b", None, None, 0, 0)


def test_long_chains_and_empty_tables(spark):
    rows = [(7, i, f"line {i}" if not i else f"> line {i - 1}\nline {i}", "", 0) for i in range(70)]
    messages = spark.createDataFrame(rows, MESSAGES)
    found = quotes.reply_conversations(messages).collect()
    assert {(r["turn"], r["root"], r["depth"], r["text"]) for r in found} == {(i, 0, i, f"line {i}") for i in range(70)}
    assert quotes.reply_conversations(messages.where("false")).count() == 0
    assert quotes.as_mails(messages.where("false")).count() == 0


def brute(rows):
    """Every quoted text against every earlier message; rows are (conv, turn, text), each message once."""
    def runs(text):
        out, level = [], None
        for line in (text or "").replace("\r\n", "\n").split("\n"):
            marks = re.match("((?:>[ \t]?)*)", line).group(1)
            at, words = marks.count(">"), line[len(marks):].lower().split()
            if at != level:
                out.append((at, []))
            level = at
            if words:
                out[-1][1].append(" ".join(words))
        return [(a, lines) for a, lines in out if lines]

    said, parents, quoted, source = {}, {}, {}, {}
    for conv, turn, text in rows:
        said[conv, turn] = {x for a, lines in runs(text) if a == 0 for x in [*lines, " ".join(lines)]}
    for conv, turn, text in rows:
        earlier = [t for c, t in said if c == conv and t < turn]
        for level in {a for a, _ in runs(text)} - {0}:
            scores = {}
            for t in earlier:
                p = sum(" ".join(lines) in said[conv, t] for a, lines in runs(text) if a == level)
                n = sum(x in said[conv, t] for a, lines in runs(text) if a == level for x in lines)
                if p or n:
                    scores[t] = (p, n, t)
            if scores:
                source[conv, turn, level] = max(scores, key=scores.get)
        quoted[conv, turn] = sum(any(x in said[conv, t] for t in earlier) for a, lines in runs(text) if a for x in lines)
    votes = collections.Counter(
        (conv, source[conv, turn, level - 1], t) for (conv, turn, level), t in source.items()
        if (conv, turn, level - 1) in source and t < source[conv, turn, level - 1]
    )
    for conv, turn, _ in rows:
        told = {t: (n, t) for (c, child, t), n in votes.items() if (c, child) == (conv, turn)}
        parents[conv, turn] = source.get((conv, turn, 1), max(told, key=told.get) if told else None)
    return {k: (parents[k], quoted[k]) for k in said}


@pytest.mark.parametrize("seed", range(3))
def test_links_equal_brute_force(spark, seed):
    pick = random.Random(seed)
    said = ["ok", "thanks", "ok\nthanks", "see you at noon\nin the hall", "ok\n\nthanks a lot", "No."]
    rows = []
    for turn in range(60):
        conv, parts = pick.randrange(2), []
        for _ in range(pick.randrange(3)):
            marks = pick.choice(["> ", ">> ", "> > ", ">"])
            text = pick.choice(said)
            text = pick.choice([text, text.replace("\n", " "), text.replace(" ", "\n", 1), text.split("\n")[-1].upper()])
            parts.append("\n".join(marks + x for x in text.split("\n")))
        rows.append((conv, turn, "\n".join([*parts, pick.choice([*said, f"own {turn}", ""])]), "", 0))
    found = quotes.reply_conversations(spark.createDataFrame(rows, MESSAGES)).collect()
    want = brute([r[:3] for r in rows])
    assert {(r["conv_id"], r["turn"]): (r["parent"], r["quoted"]) for r in found} == want


def test_the_latest_who_says_it_is_quoted(spark):
    rows = [(1, 0, "ok", "", 0), (1, 1, "what?", "", 0), (1, 2, "ok", "", 0), (1, 3, "> ok\nfine", "", 0), (1, 4, "> fine\n> ok\nthen", "", 0)]
    found = {r["turn"]: r["parent"] for r in quotes.reply_conversations(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert found == {0: None, 1: None, 2: None, 3: 2, 4: 3}


def test_quotes_wrapped_anew_and_told_by_others(spark):
    rows = [
        (1, 0, "a long line that the mail\nprogram wraps", "", 0), (1, 1, "an answer without any quote", "", 0),
        (1, 2, ">> a long line that\n>> the mail program wraps\n> an answer\n> without any quote\nI agree", "", 0),
    ]
    found = {r["turn"]: (r["parent"], r["root"], r["depth"]) for r in quotes.reply_conversations(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert found == {0: (None, 0, 0), 1: (0, 0, 1), 2: (1, 0, 2)}


def test_very_long_texts_and_repeated_lines(spark):
    long = "\n".join(f"line {i % 50}" for i in range(3000))
    rows = [(1, 0, long, "", 0), (1, 1, "\n".join("> " + x for x in long.split("\n")) + "\nread", "", 0)]
    found = {r["turn"]: (r["parent"], r["quoted"]) for r in quotes.reply_conversations(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert found == {0: (None, 0), 1: (0, 3000)}


def test_levels(spark):
    lines = {"> a": 1, ">> a": 2, "> > > a": 3, "a > b": 0, "": 0, ">": 1, " > a": 0}
    rows = spark.createDataFrame([(x,) for x in lines], "line STRING").select("line", quotes.quote_level(quotes.F.col("line")).alias("n")).collect()
    assert {r["line"]: r["n"] for r in rows} == lines

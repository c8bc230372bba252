"""Secret scans through a trigram inverted index.

Each rule's pattern is parsed once, and the trigrams that any match must hold
give a Boolean query. Every Arrow batch of texts is a segment of the index: the
postings of the rules' trigrams (trigram to rows of the segment) are built in
one pass over the bytes, intersected and united as each query says, and only the
candidates are matched against the pattern. A rule without a mandatory trigram,
such as a run of hex digits, scans every text. Texts stay where they are, so
nothing is shuffled and a segment is all that a task holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from re import _constants as op  # the names of the parsed pattern's nodes
from re import _parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALTERNATIVES = 64
SEGMENT_BYTES = 4 << 20
SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
]))


class Rule(NamedTuple):
    """A kind of secret. Matches whose ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int
    least: int


# Fixed values.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)

# Our own, found through the same index; none of them starts with an unbounded run, so a scan stays linear.
MORE_RULES = (
    Rule(
        "private_key",
        r"-----BEGIN (?:[A-Z]{1,16} ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s:,-]*?-----END (?:[A-Z]{1,16} ){0,3}PRIVATE KEY-----",
        0, 0,
    ),
    Rule(
        "vendor",
        r"(?:gh[oprsu]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})",
        0, 0,
    ),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("url", r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s/@:]{1,256}:[^\s/@]{1,256}@", 0, 0),
)
ALL_RULES = RULES + MORE_RULES

# A query is a set of alternatives, each a set of trigrams that must all occur.
# None stands for "no alternative can be excluded".
Query = frozenset[frozenset[bytes]] | None


# -- queries out of patterns -------------------------------------------------


def _texts(node: object, limit: int = ALTERNATIVES) -> set[str] | None:
    """All strings a part of a pattern can match, or None if they are too many to list."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value)}
    if kind is op.IN and all(k is op.LITERAL for k, _ in value) and len(value) <= limit:
        return {chr(v) for _, v in value}
    if kind is op.SUBPATTERN:
        return _sequence(value[3], limit)
    if kind is op.BRANCH:
        parts = [_sequence(p, limit) for p in value[1]]
        whole = set().union(*parts) if None not in parts else None
        return whole if whole and len(whole) <= limit else None
    if kind is op.MAX_REPEAT and value[1] == 1:
        inner = _sequence(value[2], limit)
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _sequence(nodes: object, limit: int) -> set[str] | None:
    whole = {""}
    for node in nodes:
        texts = _texts(node, limit)
        if texts is None or len(whole) * len(texts) > limit:
            return None
        whole = {a + b for a in whole for b in texts}
    return whole


def _of_texts(texts: set[str]) -> Query:
    alternatives = set()
    for text in texts:
        data = text.lower().encode()
        grams = frozenset(data[i:i + 3] for i in range(len(data) - 2))
        if not grams:
            return None
        alternatives.add(grams)
    return _least(alternatives)


def _least(alternatives: set[frozenset[bytes]]) -> Query:
    """Without the alternatives that another one already covers."""
    return frozenset(a for a in alternatives if not any(b < a for b in alternatives))


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a if b is None else b
    if len(a) * len(b) > ALTERNATIVES:
        return min(a, b, key=len)
    return _least({x | y for x in a for y in b})


def _needed(nodes: object) -> Query:
    """The query of a pattern: runs of listable parts give trigrams, whatever lies between gives its own or none."""
    query, run = None, {""}
    for node in nodes:
        texts = _texts(node)
        if texts is not None and len(run) * len(texts) <= ALTERNATIVES:
            run = {a + b for a in run for b in texts}
            continue
        query, run = _both(query, _of_texts(run)), texts if texts is not None else {""}
        if texts is not None:
            continue
        kind, value = node
        if kind is op.SUBPATTERN:
            query = _both(query, _needed(value[3]))
        elif kind is op.BRANCH:
            parts = [_needed(p) for p in value[1]]
            query = _both(query, None if None in parts else frozenset().union(*parts))
        elif kind is op.MAX_REPEAT and value[0] > 0:
            query = _both(query, _needed(value[2]))
    return _both(query, _of_texts(run))


def trigram_query(pattern: str) -> Query:
    """Sets of lower-cased trigrams of which one must be in any text that holds a match; None if there is no such set.

    Letters count in either case, in text and query alike, so the query holds
    for patterns that tell cases apart and for those that don't.
    """
    return _needed(_parser.parse(pattern, re.ASCII))


# -- segments ----------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Segment:
    """Postings of the wanted trigrams over a list of texts, as row numbers in order."""

    def __init__(self, texts: list[bytes], wanted: list[bytes]):
        self.rows = len(texts)
        self.postings = {gram: np.empty(0, dtype=np.int64) for gram in wanted}
        data = LOWER[np.frombuffer(b"\0".join(texts), dtype=np.uint8)]  # no trigram holds the separator
        if len(data) < 3 or not wanted:
            return
        # Only places where some wanted trigram's first two bytes stand are looked at further.
        first = np.zeros(256, dtype=bool)
        first[[g[0] for g in wanted]] = True
        second = np.zeros(256, dtype=bool)
        second[[g[1] for g in wanted]] = True
        places = np.flatnonzero(first[data[:-2]] & second[data[1:-1]])
        codes = data[places].astype(np.int64) << 16 | data[places + 1].astype(np.int64) << 8 | data[places + 2]
        grams = np.sort(np.array([int.from_bytes(g, "big") for g in wanted], dtype=np.int64))
        slot = np.minimum(np.searchsorted(grams, codes), len(grams) - 1)
        known = grams[slot] == codes
        ends = np.cumsum([len(t) + 1 for t in texts])
        row = np.searchsorted(ends, places[known], side="right")
        entries = np.unique(slot[known] * self.rows + row)
        cuts = np.searchsorted(entries, np.arange(len(grams) + 1) * self.rows)
        for i, gram in enumerate(grams.tolist()):
            self.postings[gram.to_bytes(3, "big")] = entries[cuts[i]:cuts[i + 1]] - i * self.rows

    def candidates(self, query: Query) -> np.ndarray:
        if query is None:
            return np.arange(self.rows)
        found = [np.empty(0, dtype=np.int64)]
        for alternative in query:
            rows = None
            for gram in sorted(alternative, key=lambda g: len(self.postings[g])):
                rows = self.postings[gram] if rows is None else np.intersect1d(rows, self.postings[gram], assume_unique=True)
                if not len(rows):
                    break
            found.append(rows)
        return np.unique(np.concatenate(found))


def _slices(texts: pa.Array, limit: int = SEGMENT_BYTES) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        text = text.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def secret_spans(text: Column, rules: tuple[Rule, ...] = ALL_RULES) -> Column:
    """The secrets in a text: an array of ``(kind, start, end)`` in code points, end exclusive.

    Per kind the matches are leftmost and don't overlap; those that are too
    short are dropped after matching. Spans come by start, then in the order of
    ``rules``. A null or empty text has none.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted({g for q in queries if q for alternative in q for g in alternative})
    order = {r.kind: i for i, r in enumerate(rules)}

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        matchers = [re.compile(r.pattern, re.ASCII) for r in rules]
        out = []
        for held in _slices(texts):
            segment = Segment([t.encode() for t in held], wanted)
            spans: list[list[tuple[str, int, int]]] = [[] for _ in held]
            for rule, query, matcher in zip(rules, queries, matchers):
                for row in segment.candidates(query).tolist():
                    for match in matcher.finditer(held[row]):
                        start, end = match.span(rule.group)
                        if end - start >= rule.least:
                            spans[row].append((rule.kind, *match.span()))
            out += [sorted(s, key=lambda x: (x[1], order[x[0]])) for s in spans]
        return pa.array(
            [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in out],
            pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])),
        )

    return scan(text)


def joined_spans(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """Spans as ``kind:start:end``, comma-joined; only the given kinds, if any are given."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(
        F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def find_secrets(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = ALL_RULES, out_col: str = "spans") -> DataFrame:
    """``docs`` with the column ``out_col`` of :func:`secret_spans` added (or replaced, should there be one)."""
    return docs.withColumn(out_col, secret_spans(F.col(text_col), rules))


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = ALL_RULES, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by ``mask``; overlapping spans become one mask.

    Null texts stay null, all other columns and rows as they are.
    """
    spans = "_spans_of_secrets"
    found = find_secrets(docs, text_col, rules, spans)
    merged = F.aggregate(
        F.col(spans), F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] < F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(
                    F.element_at(done, -1)["start"].alias("start"),
                    F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    text = F.col(text_col)
    pieces = F.aggregate(
        merged, F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda s, m: F.struct(
            F.concat(s["done"], F.substring(text, s["at"] + 1, m["start"] - s["at"]), F.lit(mask)).alias("done"),
            m["end"].alias("at"),
        ),
    )
    clean = F.concat(pieces["done"], F.substring(text, pieces["at"] + 1, F.length(text)))
    return found.withColumn(text_col, F.when(F.size(spans) > 0, clean).otherwise(text)).drop(spans)

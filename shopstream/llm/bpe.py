"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

A rank file (base64 bytes and rank per line) becomes a vocabulary of printable
characters, one for each byte, and a list of merges: the last merge of every
token's own encoding, in order of rank. Pieces that are a token as a whole are
looked up before any merging. Tokens that no merge yields stay reachable that way.

Texts are cut into the matches of the tokenizer's pattern, each of which is encoded
by itself. A task keeps the ids and places of the pieces it has met, up to a fixed
number, so the library encodes new pieces alone, and a batch's ids are one gather.

Decoding turns a token's characters back into bytes. A token may end inside a
UTF-8 character, so tokens are joined as bytes, and only then read as text.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

BATCH_CHARS = 1 << 19
PIECES = 500_000


# -- vocabulary --------------------------------------------------------------


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else the next one from 256 up."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printing else chr(next(others)) for b in range(256)]


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The pair whose merge completes ``token`` when its bytes are merged lowest rank first; None if none does."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            return None
        if len(parts) == 2:
            return parts[0], parts[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return None


def parse_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """The ranks in the lines of a rank file; empty lines are passed over."""
    return {base64.b64decode(row[0]): int(row[1]) for row in map(bytes.split, lines) if row}


def tokenizer_json(ranks: dict[bytes, int], pattern: str) -> str:
    """A tokenizer with these ranks as ids that encodes each match of ``pattern`` separately, without special tokens."""
    shown = byte_characters()
    text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        pair = last_merge(token, ranks) if len(token) > 1 else None
        if pair and pair[0] in ranks and pair[1] in ranks:
            merges.append((text[pair[0]], text[pair[1]]))
    vocabulary = {text[token]: rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocabulary, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return tokenizer.to_str()


# -- in tasks ----------------------------------------------------------------

_loaded: dict[str, object] = {}


def _once(kind: type, definition: str) -> object:
    """Built once per worker process, which has one core: Spark spreads the work, not the library's threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = kind.__name__ + hashlib.md5(definition.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = kind(definition)
    return _loaded[key]


def gathered(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of ``counts`` values from ``first`` on, for each of them in turn."""
    ends = np.cumsum(counts)
    return np.repeat(first - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class Tokens(NamedTuple):
    """The tokens of several texts: of text i those from ``ends[i - 1]`` up to ``ends[i]``."""

    ids: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    ends: np.ndarray
    digits: list[bytes]

    def lists(self, values: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.r_[0, self.ends], pa.int32()), pa.array(values, pa.int32()))


ESCAPE = re.compile(r"\\(?:p\{\w+\}|.)|[\[\]]", re.DOTALL)
CLASSES = re.compile(r"\\(?:p\{\w+\}|s)")


def ranges_of(characters: str) -> str:
    """Sorted characters as the inside of a bracket expression."""
    codes = np.array([ord(c) for c in characters])
    cuts = np.flatnonzero(np.diff(codes) > 1)
    first, last = codes[np.r_[0, cuts + 1]], codes[np.r_[cuts, len(codes) - 1]]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first.tolist(), last.tolist()))


def spelt_out(pattern: str, highest: int = 0x10FFFF) -> str | None:
    """``pattern`` for Python's own engine, with classes as the tokenizers library has them, up to a code point.

    Engines know different versions of Unicode; ranges leave no doubt. None if
    the pattern has an escape that this does not know.
    """
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, highest + 1))))

    def members(escape: str) -> str:
        split = pre_tokenizers.Split(Regex(escape + "+"), "removed", invert=True)
        return ranges_of("".join(piece for piece, _ in split.pre_tokenize_str(every)))

    known = {escape: members(escape) for escape in set(CLASSES.findall(pattern.replace("\\S", "\\s")))}
    out, at, inside = [], 0, False
    for found in ESCAPE.finditer(pattern):
        text = found.group()
        out.append(pattern[at:found.start()])
        at = found.end()
        if text in "[]":
            inside = text == "["
        elif text in known:
            text = known[text] if inside else f"[{known[text]}]"
        elif text == "\\S" and not inside:
            text = f"[^{known['\\s']}]"
        elif text[1].isalnum() and text not in ("\\r", "\\n", "\\t"):
            return None
        out.append(text)
    return "".join(out) + pattern[at:]


class Cutter:
    """Cuts texts into the matches of a pattern, as the tokenizers library does."""

    def __init__(self, pattern: str):
        whole = spelt_out(pattern)
        self.short = whole and re.compile(spelt_out(pattern, 0xFFFF))
        self.whole = whole and re.compile(whole)
        self.split = pre_tokenizers.Split(Regex(pattern), "isolated")

    def cut(self, text: str) -> list[str]:
        if self.whole is None:
            return [piece for piece, _ in self.split.pre_tokenize_str(text)]
        # Two bytes for each character only if none is above U+FFFF; few ranges make for quick matches.
        plain = text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text)
        return (self.short if plain else self.whole).findall(text)


class Pieces:
    """The ids and places of pieces that were met, in flat arrays; all are forgotten when there are too many."""

    def __init__(self, definition: str):
        settings = json.loads(definition)
        self.cutter = Cutter(settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.digits: list[bytes] = []
        self.used = 0
        self.first, self.count, self.chars = (np.zeros(1024, dtype=np.int64) for _ in range(3))
        self.ids, self.starts, self.stops = (np.zeros(4096, dtype=np.int32) for _ in range(3))

    def _learn(self, pieces: list[str]) -> None:
        known, need = len(self.number), len(self.number) + len(pieces)
        if need > len(self.first):
            self.first, self.count, self.chars = (np.resize(x, 2 * need) for x in (self.first, self.count, self.chars))
        found = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        ids = found.ids
        count = np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(pieces))
        end = self.used + len(ids)
        if end > len(self.ids):
            self.ids, self.starts, self.stops = (np.resize(x, 2 * end) for x in (self.ids, self.starts, self.stops))
        new = slice(self.used, end)
        self.ids[new] = ids
        self.starts[new], self.stops[new] = np.array(found.offsets, dtype=np.int32).reshape(-1, 2).T
        self.first[known:need], self.count[known:need] = self.used + np.cumsum(count) - count, count
        self.chars[known:need] = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.number.update(zip(pieces, range(known, need)))
        digits, until = list(map(str, ids)), np.r_[0, np.cumsum(count)].tolist()
        self.digits += [",".join(digits[a:b]).encode() for a, b in zip(until, until[1:])]
        self.used = end

    def encode(self, texts: list[str]) -> Tokens:
        """The texts' ids, their places in the text, and each text's ids as digits with commas."""
        cut = list(map(self.cutter.cut, texts))
        pieces = list(chain.from_iterable(cut))
        numbers = list(map(self.number.get, pieces))
        missing = [i for i, n in enumerate(numbers) if n is None]
        if missing:
            if len(self.number) > PIECES:
                self._forget()
                numbers, missing = [0] * len(pieces), range(len(pieces))
            self._learn(list(dict.fromkeys(pieces[i] for i in missing)))
            for i in missing:
                numbers[i] = self.number[pieces[i]]
        which = np.array(numbers, dtype=np.int64)
        counts, chars = self.count[which], self.chars[which]
        flat = gathered(self.first[which], counts)
        until = np.r_[0, np.cumsum([len(c) for c in cut], dtype=np.int64)]
        sums = np.r_[0, np.cumsum(chars)]
        shift = np.repeat(sums[:-1] - np.repeat(sums[until[:-1]], np.diff(until)), counts)
        digits = list(map(self.digits.__getitem__, numbers))
        return Tokens(
            self.ids[flat], self.starts[flat] + shift, self.stops[flat] + shift, np.r_[0, np.cumsum(counts)][until[1:]],
            [b",".join(digits[a:b]) for a, b in zip(until[:-1].tolist(), until[1:].tolist())],
        )


class Decoder:
    """All tokens' bytes in one array, so that many ids are decoded by one gather."""

    def __init__(self, definition: str):
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = json.loads(definition)["model"]["vocab"]
        self.starts = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        self.sizes = np.zeros_like(self.starts)
        parts, at = [], 0
        for text, rank in vocabulary.items():
            data = bytes(byte_of[c] for c in text)
            self.starts[rank], self.sizes[rank] = at, len(data)
            parts.append(data)
            at += len(data)
        self.data = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def decode(self, ids: np.ndarray, ends: np.ndarray | None = None) -> list[bytes]:
        """The bytes of each run of ids that ends at one of ``ends``; of all ids, if none are given."""
        sizes = self.sizes[ids]
        data = self.data[gathered(self.starts[ids], sizes)].tobytes()
        until = np.r_[0, np.cumsum(sizes)][[0, *([len(ids)] if ends is None else ends)]].tolist()
        return [data[a:b] for a, b in zip(until, until[1:])]


def _some(texts: Iterable[str], limit: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Lists of texts of about ``limit`` characters, so that no batch of encodings grows large."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


# -- columns -----------------------------------------------------------------


def _encoded(batches: Iterator[pa.Array], definition: str) -> Iterator[list[Tokens]]:
    pieces = _once(Pieces, definition)
    for batch in batches:
        yield [pieces.encode(held) for held in _some(t.as_py() or "" for t in batch)]


def _one(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


INTS = pa.list_(pa.int32())


def ids_of(text: Column, definition: str) -> Column:
    """The token ids of a text; none for a null or empty one."""

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for found in _encoded(batches, definition):
            yield _one([t.lists(t.ids) for t in found], INTS)

    return encode(text)


TOKENS = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    T.StructField("starts", T.ArrayType(T.IntegerType(), False)),
    T.StructField("ends", T.ArrayType(T.IntegerType(), False)),
])


def tokens_of(text: Column, definition: str) -> Column:
    """Ids with each token's place in the text, in code points and end exclusive.

    A token that holds only a part of a character's bytes covers the whole character.
    """

    @F.arrow_udf(TOKENS)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for found in _encoded(batches, definition):
            values = [[getattr(t, name) for t in found] for name in ("ids", "starts", "stops")]
            columns = [_one([t.lists(v) for t, v in zip(found, each)], INTS) for each in values]
            yield pa.StructArray.from_arrays(columns, ["ids", "starts", "ends"])

    return encode(text)


DIGESTS = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()), T.StructField("places_sha256", T.StringType()),
])


def digests_of(text: Column, definition: str) -> Column:
    """What tells a text's tokens, where neither they nor their bytes are wanted themselves.

    The number of ids; SHA-256 of the ids as decimals joined by commas, of the
    bytes that the ids decode to, and of the tokens' places: all starts, then all
    ends, as little-endian 32-bit numbers.
    """

    @F.arrow_udf(DIGESTS)
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _once(Decoder, definition)
        for found in _encoded(batches, definition):
            counts, ids, decoded, places = [], [], [], []
            for t in found:
                starts, stops, begins = t.starts.astype("<i4"), t.stops.astype("<i4"), np.r_[0, t.ends].tolist()
                counts += np.diff(t.ends, prepend=0).tolist()
                ids += [hashlib.sha256(d).hexdigest() for d in t.digits]
                decoded += [hashlib.sha256(d).hexdigest() for d in decoder.decode(t.ids, t.ends)]
                for a, b in zip(begins, begins[1:]):
                    sha = hashlib.sha256(starts[a:b].tobytes())
                    sha.update(stops[a:b].tobytes())
                    places.append(sha.hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), *[pa.array(x, pa.string()) for x in (ids, decoded, places)]], DIGESTS.names,
            )

    return digest(text)


def bytes_of(ids: Column, definition: str) -> Column:
    """The bytes that ids stand for, whole even where they end inside a character; none for null or no ids."""

    @F.arrow_udf(T.BinaryType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _once(Decoder, definition)
        for batch in batches:
            yield pa.array([decoder.decode(_row(batch, i))[0] for i in range(len(batch))], pa.binary())

    return decode(ids)


def _row(lists: pa.ListArray, i: int) -> np.ndarray:
    value = lists[i].values
    return value.to_numpy(zero_copy_only=False) if value is not None else np.empty(0, dtype=np.int32)


def encode_documents(docs: DataFrame, definition: str, text_col: str = "text", offsets: bool = True) -> DataFrame:
    """``docs`` with the columns ``ids`` and, if asked for, ``starts`` and ``ends`` added or replaced."""
    if not offsets:
        return docs.withColumn("ids", ids_of(F.col(text_col), definition))
    found = docs.select(F.struct(*docs.columns).alias("doc"), tokens_of(F.col(text_col), definition).alias("tokens"))
    added = {n: F.col(f"tokens.{n}") for n in ("ids", "starts", "ends")}
    return found.select(*[F.col(f"doc.{c}") for c in docs.columns if c not in added], *[c.alias(n) for n, c in added.items()])


def decode_documents(docs: DataFrame, definition: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the decoded bytes of ``ids_col`` as the binary column ``out_col``, added or replaced.

    Cast it to string for text; bytes that are no valid UTF-8 are kept as they are.
    """
    return docs.withColumn(out_col, bytes_of(F.col(ids_col), definition))

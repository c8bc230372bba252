"""Against the tiktoken library, which reads the same ranks."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from shopstream.llm import bpe, queries

TEXTS = [
    None, "", " ", "  \n\t ", "Hello  world's 123 $$$", "naïve élan ñandú", "日本語 テキスト", "😀👍🏽 á", "a" * 5000, "\u0085 x　y",
    "<|endoftext|>", "tab\tand\r\nline", "'s 'll'd", "x" + " " * 300 + "y", "\x00\x1c",
]


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return bpe.parse_ranks(file)


@pytest.fixture(scope="module")
def definition(ranks):
    return bpe.tokenizer_json(ranks, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def known(ranks):
    return tiktoken.Encoding("known", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture
def docs(spark):
    rows = [(i, t, "x", [1]) for i, t in enumerate(TEXTS)] + [(None, "again", "x", [1]), (4, TEXTS[4], "x", [1])]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, decoded STRING, starts ARRAY<INT>")


def test_ids_equal_tiktoken_and_decode_to_the_text(docs, definition, known):
    found = bpe.decode_documents(bpe.encode_documents(docs, definition, offsets=False), definition).collect()
    assert len(found) == len(TEXTS) + 2
    for row in found:
        assert row["ids"] == known.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()


def test_places_cover_each_token_and_clashing_columns_are_replaced(docs, definition):
    found = bpe.encode_documents(docs, definition)
    assert sorted(found.columns) == ["decoded", "doc_id", "ends", "ids", "starts", "text"]
    for row in found.collect():
        text = row["text"] or ""
        assert len(row["starts"]) == len(row["ends"]) == len(row["ids"])
        covered = sorted({p for a, b in zip(row["starts"], row["ends"]) for p in range(a, b)})
        assert covered == list(range(len(text)))


def test_a_split_character_keeps_its_bytes(spark, definition, known):
    ids = known.encode_ordinary("😀")
    assert len(ids) > 1
    rows = spark.createDataFrame([(ids[:1],), (ids,), ([],), (None,)], "ids ARRAY<INT>")
    found = [bytes(r["decoded"]) for r in bpe.decode_documents(rows, definition).collect()]
    assert found == [known.decode_bytes(ids[:1]), "😀".encode(), b"", b""]


def test_every_token_decodes_to_its_bytes(ranks, definition):
    decoder = bpe.Decoder(definition)
    assert all(decoder.decode(np.array([rank])) == [token] for token, rank in ranks.items())


def test_empty_table(spark, docs, definition):
    assert bpe.encode_documents(docs.where("false"), definition).count() == 0


def test_every_character_is_cut_as_by_the_library(definition, known):
    pieces = bpe.Pieces(definition)
    for start in range(0, 0x110000, 1 << 12):
        characters = [chr(c) for c in range(start, start + (1 << 12)) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c} 1{c}{c}  {c}" for c in characters)
        assert pieces.encode([text]).ids.tolist() == known.encode_ordinary(text)


def test_pieces_that_are_forgotten_are_learnt_again(definition, known, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 50)
    pieces = bpe.Pieces(definition)
    for i in range(40):
        texts = [f"word{j} {i} again and again" for j in range(i)] + TEXTS[1:] * (i % 3)
        found = pieces.encode(texts)
        assert [x.tolist() for x in np.split(found.ids, found.ends)[:-1]] == [known.encode_ordinary(t) for t in texts]
        assert found.digits == [",".join(map(str, known.encode_ordinary(t))).encode() for t in texts]


def test_query(spark, known, definition):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    found = queries.op1_bpe(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = known.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
    tokens = bpe.encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), definition).collect()
    places = {r["doc_id"]: np.array([*r["starts"], *r["ends"]], dtype="<i4").tobytes() for r in tokens}
    assert {r["doc_id"]: r["places_sha256"] for r in found} == {i: hashlib.sha256(p).hexdigest() for i, p in places.items()}

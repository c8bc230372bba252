import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstream.llm import packing


def padded(bounds, lengths, counts):
    return sum(c * min(b for b in bounds if b >= x) for x, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    pick = random.Random(1)
    for _ in range(200):
        lengths = sorted(pick.sample(range(1, 40), pick.randint(1, 8)))
        counts = [pick.randint(1, 9) for _ in lengths]
        buckets = pick.randint(1, 4)
        found = packing.optimal_boundaries(np.array(lengths), np.array(counts), buckets)
        best = min(
            padded((*inner, lengths[-1]), lengths, counts)
            for n in range(buckets) for inner in itertools.combinations(lengths[:-1], n)
        )
        assert len(found) <= buckets and found == sorted(found) and padded(found, lengths, counts) == best


@pytest.fixture
def docs(spark):
    pick = random.Random(2)
    rows = [(i, "w " * pick.choice([1, 3, 3, 3, 7, 20, 55]), "x", 1) for i in range(300)]
    rows += [(None, "a b", "x", 1), (5, "a b", "x", 1), (5, "a b", "x", 1), (900, None, "x", 1), (901, " \n", "x", 1), (902, "w " * 100_000, "", 0)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, bucket STRING, length INT")


@pytest.mark.parametrize("slice_rows", [500_000, 7])
def test_every_token_is_in_one_batch_within_budget(docs, slice_rows):
    rows = packing.pack_documents(docs, packing.word_count(F.col("text")), max_len=16, buckets=3, budget=64, slice_rows=slice_rows).collect()
    want = {}
    for r in docs.collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + len((r["text"] or "").split())
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want
    batches = {}
    for r in rows:
        if r["length"]:
            assert r["padding"] == r["bucket"] - r["length"] >= 0
            batches.setdefault((r["bucket"], r["batch"]), []).append(r["slot"])
        else:
            assert (r["bucket"], r["batch"], r["slot"], r["padding"]) == (None,) * 4
    for bucket in {b for b, _ in batches}:
        own = sorted(n for b, n in batches if b == bucket)
        assert own == list(range(len(own)))
        for n in own:
            slots = sorted(batches[bucket, n])
            assert slots == list(range(len(slots))) and len(slots) * bucket <= 64
            assert n == own[-1] or len(slots) == 64 // bucket


def test_empty_tables(docs):
    length = packing.word_count(F.col("text"))
    assert packing.pack_documents(docs.where("false"), length).count() == 0
    nothing = packing.pack_documents(docs.where("doc_id IN (900, 901)"), length).collect()
    assert [(r["length"], r["batch"]) for r in nothing] == [(0, None)] * 2

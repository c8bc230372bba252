import random
import re

import numpy as np
import pytest
import xxhash

from shopstream.llm import queries, simhash
from shopstream.llm.components import connected_components

DOCS = "doc_id BIGINT, text STRING, fp STRING, component STRING, node INT"


def plain_print(text, size=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    runs = [" ".join(words[i:i + size]) for i in range(max(0, len(words) - size + 1))] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(ids, alike):
    """The smallest id reachable from each place, by repeated lowering."""
    low = [(i is None, i or 0) for i in ids]
    while True:
        new = [min(low[j] for j in range(len(ids)) if alike(k, j)) for k in range(len(ids))]
        if new == low:
            return [None if n else i for n, i in low]
        low = new


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice("abcdefgh") + pick.choice("aeiou") + str(pick.randrange(30)) for _ in range(n))


def rough_docs():
    texts = [None, "", " \t\n", "one", "one two three", "ONE two three four", "one two three four"]
    texts += [prose(1, 200), prose(1, 200).upper(), prose(1, 199), prose(2, 60) + " x", prose(2, 60), prose(3, 30000), prose(3, 29990)]
    return texts + [prose(s, 40) for s in range(20, 60)]


@pytest.fixture
def docs(spark):
    texts = rough_docs()
    rows = [(i + 5, t, "x", "y", 1) for i, t in enumerate(texts)] + [(None, texts[7], "", "", 0), (12, texts[7], "", "", 0), (12, "other", "", "", 0)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("aim, shard_rows", [(512, 4096), (4, 3)])
def test_components_equal_brute_force(docs, aim, shard_rows):
    rows = docs.collect()
    prints = [plain_print(r["text"]) for r in rows]
    want = plain_groups([r["doc_id"] for r in rows], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    found = simhash.simhash_components(docs, aim=aim, shard_rows=shard_rows).select("doc_id", simhash.hex_digits(simhash.F.col("fp")), "component_id")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        str((r["doc_id"], f"{p:016x}", w)) for r, p, w in zip(rows, prints, want)
    )


def test_empty_table_and_unknown_ids(spark, docs):
    assert simhash.simhash_components(docs.where("false")).count() == 0
    nameless = docs.where("doc_id IS NULL")
    assert [r["component_id"] for r in simhash.simhash_components(nameless).collect()] == [None]
    assert simhash.keep_one_of_each(docs.where("false")).count() == 0


@pytest.mark.parametrize("count", [1, 10**4, 10**7, 10**10])
def test_shard_plan_leaves_no_close_pair_apart(count):
    combinations, bits = simhash.shard_plan(count, 4)
    pick = random.Random(count)
    for _ in range(200):
        far = set(pick.sample(range(64), 4))
        assert any(all(not far & set(range(a, a + w)) for a, w in c) for c in combinations)
    assert all(sum(w for _, w in c) >= bits for c in combinations)
    assert count / 2**bits <= 2 * simhash.AIM_ROWS


def test_tree_finds_all_within_the_radius():
    points = np.random.default_rng(1).integers(0, 2**63, (300, 1), dtype=np.uint64)
    points[100:200] = points[:100] ^ np.uint64(7)
    query, node = simhash.Tree(points).within(points, 4)
    near = np.bitwise_count(points ^ points.T) <= 4
    assert set(zip(query.tolist(), node.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(near))))


def test_one_of_each_stays(docs):
    rows = docs.collect()
    prints = [plain_print(r["text"]) for r in rows]
    group = plain_groups(list(range(len(rows))), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    want = {}
    for place, row in zip(group, rows):
        want[place] = min(want.get(place, 10**9), row["doc_id"] if row["doc_id"] is not None else 10**9)
    kept = simhash.keep_one_of_each(docs).collect()
    assert sorted(r["doc_id"] if r["doc_id"] is not None else 10**9 for r in kept) == sorted(want.values())
    assert all(tuple(k) in {tuple(r) for r in rows} for k in kept) and kept[0].__fields__ == docs.columns


def test_rows_alike_in_all_keep_one(spark):
    rows = [(1, "a b c", "x")] * 3 + [(None, "a b c", "x"), (None, None, "y"), (None, " ", "y")]
    kept = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, row STRING")).collect()
    assert sorted(r["row"] for r in kept) == ["x", "y"] and {r["doc_id"] for r in kept} == {1, None}


def test_components_of_chains_stars_and_bad_links(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (200, None), (1, 0), (1, 0)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()))
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = [plain_print(r["text"]) for r in docs]
    want = plain_groups([r["doc_id"] for r in docs], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op3_simhash(spark, sf_dir).collect()}
    assert found == {r["doc_id"]: (f"{p:016x}", w) for r, p, w in zip(docs, prints, want)}

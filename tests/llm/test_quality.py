import zlib

import numpy as np
import pytest

from shopstream.llm import quality, queries

DOCS = "doc_id BIGINT, text STRING, quality INT, score STRING, features INT"


@pytest.fixture
def docs(spark):
    rows = [(i, f"Some plain words of number {i} that go on for a while. And then more.", 9, "s", 0) for i in range(60)]
    rows += [(100 + i, f"BUY!! NOW!! $$$ ### {i} @@@ !!! ***", 9, "s", 0) for i in range(40)]
    rows += [(200, None, 0, "", 0), (201, "", 0, "", 0), (202, "x" * 300_000, 0, "", 0), (None, "text", 0, "", 0), (5, "A second row.", 0, "", 0)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def labels(spark):
    rows = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(40)]
    rows += [(None, 1, 1), (3, None, 0), (4, 7, 0), (5, 1, 0), (999, 0, 0)]
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")


def test_statistics_are_finite():
    for text in ["", " ", "a", "\n\n", "😀" * 10, "x" * 100_000, "Ünïcode ÉÉ 12 !!"]:
        found = quality.statistics(text)
        assert len(found) == len(quality.FEATURES) and np.isfinite(found).all()


def test_scores_tell_classes_apart_on_held_out_rows(docs, labels):
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    for row in rows:
        held = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2
        assert row["held_out"] == held and 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7)
    told = [(r["predicted"] == (r["doc_id"] < 60)) for r in rows if r["doc_id"] is not None and (r["doc_id"] < 60 or 100 <= r["doc_id"] < 140)]
    assert np.mean(told) > 0.95


def test_held_out_labels_change_nothing(spark, docs, labels):
    flipped = labels.withColumn("quality", quality.F.when(quality.is_held_out(quality.F.col("doc_id")), 1 - labels.quality).otherwise(labels.quality))
    a, b = (sorted((str(r["doc_id"]), r["score"]) for r in quality.score_documents(docs, x).collect()) for x in (labels, flipped))
    assert np.allclose([s for _, s in a], [s for _, s in b])


def test_model_equals_the_formula():
    pick = np.random.default_rng(3)
    x = {0: pick.normal(0, 1, (50, 3)), 1: pick.normal(1, 2, (80, 3))}
    model = quality.model_of({k: (len(v), v.sum(0), v.T @ v) for k, v in x.items()}, to_pooled=0, to_diagonal=0, ridge=0)
    at = np.array([[0.3, -0.2, 1.0]])
    logs = []
    for k, v in x.items():
        mean, cov = v.mean(0), np.cov(v.T, bias=True)
        gap = at[0] - mean
        logs.append(np.log(len(v) / 130) - 0.5 * gap @ np.linalg.solve(cov, gap) - 0.5 * np.log(np.linalg.det(cov)))
    assert np.isclose(model.scores(at)[0], 1 / (1 + np.exp(logs[0] - logs[1])))


def test_query_equals_the_formula_with_shrinkage(spark):
    """Statistics, moments and densities over again, with determinants and solves instead of cached factors."""
    sf_dir = "/root/testdata/sf0.001"
    known = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r["quality"] in (0, 1)}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    x = {i: np.array(quality.statistics(t)) for i, t in texts.items()}
    learnt = [i for i in known if i in x and zlib.crc32(str(i).encode()) % 4 != 2]
    rows = {k: np.array([x[i] for i in learnt if known[i] == k]) for k in (0, 1)}
    own = {k: np.cov(v.T, bias=True) for k, v in rows.items()}
    pooled = sum(len(rows[k]) * own[k] for k in rows) / len(learnt)
    logs = {}
    for k, v in rows.items():
        mixed = (1 - quality.TO_POOLED) * own[k] + quality.TO_POOLED * pooled
        mixed = (1 - quality.TO_DIAGONAL) * mixed + quality.TO_DIAGONAL * np.diag(np.diag(mixed)) + quality.RIDGE * np.eye(len(mixed))
        logs[k] = {
            i: np.log(len(v) / len(learnt)) - 0.5 * (f - v.mean(0)) @ np.linalg.solve(mixed, f - v.mean(0)) - 0.5 * np.linalg.slogdet(mixed)[1]
            for i, f in x.items()
        }
    found = {r["doc_id"]: r["score"] for r in queries.op6_quality(spark, sf_dir).collect()}
    assert set(found) == set(texts)
    for i, score in found.items():
        assert np.isclose(score, 1 / (1 + np.exp(np.clip(logs[0][i] - logs[1][i], -500, 500))), atol=1e-6)


@pytest.mark.parametrize("only, score", [(None, 1.0), (1, 1.0), (0, 0.0)])
def test_one_class_or_none_gives_one_score(docs, labels, only, score):
    few = labels.where("false" if only is None else f"quality = {only}")
    assert {r["score"] for r in quality.score_documents(docs, few).collect()} == {score}


def test_keeps_good_rows_with_all_columns(docs, labels):
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert set(range(60)) - set(ids) == set() and not [i for i in ids if i and 100 <= i < 140]
    assert quality.keep_good(docs.where("false"), labels).count() == 0


def test_query_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    known = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in queries.op6_quality(spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in known]
    assert np.mean([r["predicted"] == known[r["doc_id"]] for r in rows]) > 0.95

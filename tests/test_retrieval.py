"""Top-k in blocks and the inverted file against exact cosine by brute force."""

import random

import numpy as np
import pytest

from colloquy.operators import retrieval as R


def brute(vectors, queries, k):
    out = set()
    for qid, q in queries:
        hits = []
        for vid, v in vectors:
            if v is None or q is None or not np.linalg.norm(v) or not np.linalg.norm(q):
                continue
            hits.append((-round(float(np.dot(q, v) / np.linalg.norm(q) / np.linalg.norm(v)), 9), vid))
        out |= {(qid, vid, i + 1) for i, (_, vid) in enumerate(sorted(hits)[:k])}
    return out


def frames(spark, vectors, queries):
    return (spark.createDataFrame(vectors, "vec_id long, embedding array<float>"),
            spark.createDataFrame(queries, "query_id long, embedding array<float>"))


@pytest.fixture
def data():
    rnd = random.Random(2)
    point = lambda: [float(rnd.randint(-3, 3)) for _ in range(6)]  # noqa: E731 - many ties
    vectors = [(i, point()) for i in range(400)] + [(400 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(150)]
    vectors += [(900, None), (901, [0.0] * 6)]
    rnd.shuffle(vectors)
    queries = [(i, point()) for i in range(90)] + [(90, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (91, None), (92, [0.0] * 6)]
    return vectors, queries


def test_every_query_meets_every_vector(spark, data, monkeypatch):
    monkeypatch.setattr(R, "QUERY_BYTES", 8 * 6 * 20)  # twenty queries a cell
    monkeypatch.setattr(R, "CELL_VECTORS", 60)
    monkeypatch.setattr(R, "TILE", 16)
    monkeypatch.setattr(R, "FAN", 3)
    got = R.vector_topk(*frames(spark, *data), 5).collect()
    assert {(r.query_id, r.vec_id, r.rank) for r in got} == brute(*data, 5)
    assert all(abs(r.score) <= 1 + 1e-9 for r in got)


def test_defaults_and_fewer_vectors_than_k(spark, data):
    vectors, queries = data[0][:3], data[1]
    got = R.vector_topk(*frames(spark, vectors, queries), 5).collect()
    assert {(r.query_id, r.vec_id, r.rank) for r in got} == brute(vectors, queries, 5)


def test_empty_sides(spark, data):
    v, q = frames(spark, *data)
    assert R.vector_topk(v.limit(0), q, 5).count() == 0
    assert R.vector_topk(v, q.limit(0), 5).count() == 0


def test_inverted_file_posts_every_vector_and_finds_nine_of_ten(spark):
    rnd = np.random.default_rng(5)
    middles = rnd.normal(size=(40, 16))
    vectors = [(i, (middles[i % 40] + 0.3 * rnd.normal(size=16)).tolist()) for i in range(1500)]
    vectors += [(2000 + i, middles[0].tolist()) for i in range(500)]  # one very common vector
    v = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    q = v.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    index = R.InvertedFile(v)
    assert index.postings.count() == len(vectors) and index.postings.select("id").distinct().count() == len(vectors)
    found, exact = index.search(q, 5, probes=4), R.vector_topk(v, q, 5)
    assert R.recall(found, exact).first()["recall"] >= 0.9
    share = index.candidates(q, probes=4).first()
    assert share["queries"] == q.count() and share["pairs"] == q.count() * len(vectors) and share["scored"] < share["pairs"]
    probes = index.probes_for(0.95)
    few = index.candidates(q, probes).first()
    assert R.recall(index.search(q, 5, probes), exact).first()["recall"] >= 0.9 and 10 * few["scored"] < 4 * few["pairs"]
    every = index.search(q, 5, probes=len(index.centres)).collect()
    assert {(r.query_id, r.vec_id, r.rank) for r in every} == {(r.query_id, r.vec_id, r.rank) for r in exact.collect()}


def test_hashing_embed(spark):
    rows = spark.createDataFrame([(1, "A a b"), (2, None), (3, "...")], "id long, t string")
    got = {r.id: r.embedding for r in R.hashing_embed(rows, "t").collect()}
    import hashlib
    slot = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:2], 16)
    assert len(got[1]) == 256 and got[1][slot("a")] == pytest.approx(2 / 5 ** 0.5) and got[1][slot("b")] == pytest.approx(1 / 5 ** 0.5)
    assert not any(got[2]) and not any(got[3])

import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from colloquy.llm import toxicity
from tests.llm.conftest import SF

BIG = SF.replace("0.001", "0.1")


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.fit(docs, labels.where(~toxicity.is_held_out()))


def test_held_out_accuracy_on_the_whole_table(spark, model):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, labels, model).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(toxic[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert np.mean([t == p for t, p in held]) > 0.94
    assert np.mean([p for t, p in held if t]) > 0.7


def test_misspellings_score_high(model):
    base = "and the of with thing reation to the as was for and the with the "
    score = lambda t: float(model.score(pa.array([t], pa.large_string()))[0])
    assert score(base * 3) < 0.5 < score(base + "idiot loser " + base)
    assert score(base * 3) < score(base + "idiott stupidd " + base)


def test_only_rows_that_are_not_held_out_are_learned(spark, docs_of):
    rows = [(i, "bad words here" if i % 2 else "fine text there") for i in range(60)]
    labels = spark.createDataFrame([(i, None, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    flipped = spark.createDataFrame(
        [(i, None, 1 - i % 2 if zlib.crc32(str(i).encode()) % 5 == 0 else i % 2) for i, _ in rows],
        "doc_id long, quality int, toxic int")
    a, b = (sorted(tuple(r) for r in toxicity.score(docs_of(rows), x).collect()) for x in (labels, flipped))
    assert a == b


def test_edge_rows(spark, docs_of, model):
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (None, "idiot moron loser"), (5, "word " * 30_000 + "idiot moron"),
            (5, "word " * 30_000 + "idiot moron"), (6, "x" * 50_000)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs_of(rows), none, model).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (1, 2)} == {got[0]["score"]}
    assert next(r["predicted"] for r in got if r["doc_id"] is None) == 1
    assert toxicity.score(docs_of([]), none, model).count() == 0
    assert {r["score"] for r in toxicity.score(docs_of(rows), none).collect()} == {0.0}


def test_labelled_texts_of_every_length_are_learned_from(spark, docs_of):
    """Toxic texts that are all long, behind short rows that the sample would take first."""
    plain = "some fine words of a quiet text about nothing "
    rows = [(i, plain * (300 + i) + "idiot moron loser " * 4 + plain * 40) for i in range(1, 60, 2)]
    rows += [(i, plain * (1 + i % 7) + str(i)) for i in range(0, 400, 2)] + [(901, plain * 30_000 + "idiot moron loser " * 4)]
    assert all(len(t) > 12_000 for i, t in rows if i % 2)
    labels = spark.createDataFrame([(i, None, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs_of(rows), labels.where(~toxicity.is_held_out()))
    assert model is not None
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs_of(rows), labels, model).collect()}
    assert np.mean([got[i] == i % 2 for i, _ in rows if i != 901]) > 0.95


def test_the_sample_is_bounded_in_rows_and_bytes():
    strata = {(0, 8): (10 ** 8, 30 * 10 ** 9), (0, 13): (10 ** 6, 10 ** 10), (0, 20): (3, 3 << 20), (1, 9): (40, 25_000)}
    got = toxicity.quotas(strata, toxicity.SAMPLE, toxicity.SAMPLE_BYTES)
    assert got[0, 20] == 3 and got[1, 9] == 40 and got[0, 13] > toxicity.LEAST
    assert sum(n for (t, _), n in got.items() if t == 0) <= toxicity.SAMPLE[0] + 2 * toxicity.LEAST


def test_words_are_stripped_in_linear_time():
    plain = lambda w: re.sub(r"^(?:[^\w]|[\d_])+|(?:[^\w]|[\d_])+$", "", w.lower())
    words = ["--a1b!!", "123", "_x_", "\u00c9t\u00e9.", "...", "a", "9z9z9", "\u0130x\u0307!"]
    got = toxicity._STRIP.sub("", toxicity._STRIP.sub("", "\n".join(words).lower())[::-1])[::-1].split("\n")
    assert got == [plain(w) for w in words]
    began = time.monotonic()
    for piece in ("-", "1", "x-", "_"):
        toxicity.Bags(["a" + piece * (500_000 // len(piece)) + "b"])
    assert time.monotonic() - began < 30

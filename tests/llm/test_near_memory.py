"""What the near-duplicate join holds in an executor outside the heap."""

import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

from colloquy.llm import ngram_join as nj
from colloquy.llm import textbytes as tb
from colloquy.session import small_batches

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def default_batches(spark):
    was = spark.conf.get(BATCH)
    spark.conf.unset(BATCH)
    yield
    spark.conf.set(BATCH, was)


def test_hashing_holds_little_beside_the_text():
    """pipeline, round 3: an executor's workers took some 200 MB each"""
    texts = pa.array(["".join(f"word{i % 977} of a row " for i in range(20_000))] * 12)
    tb.word_hashes(texts[:1])
    tracemalloc.start()
    hashes, edges = tb.word_hashes(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(hashes) == edges[-1] == 12 * 80_000
    assert peak - 4 * hashes.nbytes < 16 << 20  # hashes and begins, in blocks and joined
    assert tb._POW.nbytes + tb._INV.nbytes <= 8 << 20


def test_words_do_not_depend_on_blocks():
    text = "x" * (3 * tb.BLOCK_BYTES + 5) + " tail " + "some words " * 50_000
    whole, edges = tb.word_hashes(pa.array([text, "some words", None]))
    few, _ = tb.word_hashes(pa.array(["some words tail"]))
    assert edges.tolist() == [0, 100_002, 100_004, 100_004]
    assert whole[1] == few[2] and set(whole[2:].tolist()) == set(few[:2].tolist())


def test_no_rows_come_from_the_drivers_python(docs_of, monkeypatch):
    """pipeline, round 3: empty tables made from lists started three more processes in each executor"""
    docs = docs_of(["a b c d e f g h i j"] * 2 + [" ".join(f"w{i}" for i in range(40)), None])

    def refuse(*args, **kw):
        raise AssertionError("rows from the driver")
    monkeypatch.setattr(SparkSession, "createDataFrame", refuse)
    got = {r.doc_id: r.component_id for r in nj.components_of(docs, nj.Rule()).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3}


def test_batches_go_by_bytes(spark, docs_of, default_batches):
    """pipeline, round 3: 10,000 texts lay in a batch"""
    nj.components_of(docs_of(["one two three"]), nj.Rule()).collect()
    rows = spark.range(0, 9000, 1, 1).selectExpr("repeat('x', 2000) AS t")
    sizes = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches),
                            "n long").collect()
    assert max(r.n for r in sizes) < 5 << 20
    spark.conf.set(BATCH, "1m")
    small_batches(spark)
    assert spark.conf.get(BATCH) == "1m"

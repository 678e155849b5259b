"""What the near-duplicate join writes beside its shuffles, and the jobs it takes."""

import numpy as np
import pytest

from colloquy.llm import ngram_join as nj
from colloquy.session import cut_lineage


def _texts():
    rng = np.random.default_rng(5)
    rows = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 60)) for _ in range(30)]
    return rows + [t + " more" for t in rows[:10]] + rows[:5] + ["", None, "two words"]


@pytest.mark.parametrize("rule", [nj.Rule(), nj.Rule(size=3, num=90)])
def test_signatures_are_written_nowhere(docs_of, monkeypatch, rule):
    """pipeline, round 3: a table of signatures lay beside their shuffle"""
    wrote = []
    monkeypatch.setattr(nj, "cut_lineage", lambda df: wrote.append(df.dtypes) or cut_lineage(df))
    got = {r.doc_id: r.component_id for r in nj.components_of(docs_of(_texts()), rule).collect()}
    assert all(got[30 + i] == i for i in range(10)) and all(got[40 + i] == i for i in range(5))
    assert wrote and not any(kind.startswith("array<bigint>") for table in wrote for _, kind in table)


def test_no_set_has_more_signatures_than_said(docs_of):
    """pipeline, round 3: the bits that are moved go by this number"""
    docs = nj.F.xxhash64("text").alias("key")
    docs = docs_of(_texts()).select("doc_id", "text", docs)
    rows = nj._features(docs, nj.Rule()).collect()
    assert all(len(r.sigs) <= r.n_sigs for r in rows) and any(r.n_sigs > 0 for r in rows)
    assert all(not r.sigs and r.n_sigs == 0 for r in rows if r.n_shingles == 0)
    assert all(not r.sigs for r in nj._features(docs, nj.Rule(), signed=False).collect())


def test_a_cut_is_one_job(spark):
    """pipeline, round 3: the driver kept a second job for each table written"""
    rows = spark.createDataFrame([(1, "a"), (None, None)], "x long, y string")
    spark.sparkContext.setJobGroup("one-cut", "")
    try:
        cut = cut_lineage(rows)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-cut")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert cut.dtypes == rows.dtypes and {tuple(r) for r in cut.collect()} == {(1, "a"), (None, None)}

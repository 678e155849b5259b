import pyarrow as pa
import pytest

from colloquy.llm import quality
from tests.llm.conftest import SF

BIG = SF.replace("0.001", "0.1")


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    test = labels.where("doc_id % 4 = 0")
    scored = quality.score(docs, labels.where("doc_id % 4 != 0")).join(test, "doc_id").collect()
    good = [r["keep"] for r in scored if r["quality"] == 1]
    bad = [r["keep"] for r in scored if r["quality"] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.05
    assert all(0 <= r[c] <= 1 for r in scored for c in ("score_text", "score_meta", "score"))


def test_pseudo_labels_teach_the_other_view():
    """A view with few labels gains from what a sure view hands over."""
    import numpy as np
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 1200)
    a = np.stack([(2 * y - 1) * 4 + rng.normal(size=1200), rng.normal(size=1200)], 1)
    b = np.concatenate([(2 * y - 1)[:, None] * 0.8 + rng.normal(size=(1200, 1)), rng.normal(size=(1200, 40))], 1)
    few, pool, test = slice(0, 60), slice(60, 800), slice(800, 1200)
    accuracy = []
    for rounds in (0, 4):
        m = quality.co_train(a[few], b[few], y[few], np.ones(60), a[pool], b[pool], rounds)
        accuracy.append((((m.meta.log_odds(b[test]) > 0) == y[test]).mean()))
    assert accuracy[1] > accuracy[0]


def test_query_covers_the_whole_table(spark, queries):
    ids = [r["doc_id"] for r in queries["op4_co_training"](spark, SF).collect()]
    assert sorted(ids) == sorted(r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet")


def test_edge_rows(spark, docs_of, labels):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    model = quality.fit(docs, labels)
    odd = docs_of([(1, None), (2, ""), (3, " \n"), (None, "Te " * 400), (5, "Te " * 30_000), (5, "Te " * 30_000)])
    got = {str(r["doc_id"]): (r["score"], r["keep"]) for r in quality.score(odd, labels, model).collect()}
    assert got["1"] == got["2"] == got["3"] == (0.0, 0) and got["None"][1] == 0 and got["5"][1] == 0
    bare = odd.select("doc_id", "text")  # no metadata at all
    assert quality.score(bare, labels, model).count() == 6
    assert quality.score(docs_of([]), labels).count() == 0
    none = quality.score(odd, labels.limit(0)).collect()
    assert {str(r["doc_id"]): r["keep"] for r in none} == {"1": 0, "2": 0, "3": 0, "None": 1, "5": 1}


def test_filter_equals_scores_and_keeps_columns(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    kept = quality.keep_good(docs.withColumn("score", docs["lang"]), labels)
    assert kept.columns == [*docs.columns, "score"]
    want = sorted(r["doc_id"] for r in quality.score(docs, labels).where("keep = 1").collect())
    assert sorted(r["doc_id"] for r in kept.collect()) == want and len(want) < docs.count()


def test_all_unlabelled_rows_are_in_the_exchange(spark, docs_of, monkeypatch):
    """A rare source among many unlabelled rows hands rows over, and no pair more than its bound."""
    from pyspark.sql import functions as F
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    good = lambda i: f"The {words[i % 10]} of {words[i // 10 % 10]} was seen near {i} hills, and then it rained."
    bad = lambda i: f"| {i} || ## {i} | buy buy buy buy | $$ {i} ||"
    docs = docs_of([(i, good(i) if i % 2 else bad(i)) for i in range(7400)]).withColumn(
        "source", F.when(F.col("doc_id") >= 7396, "rare").otherwise("s"))
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    handed, plain = [], quality.sure_rows

    def seen(pool, views, given, each):
        assert pool.count() == 7200
        out = plain(pool, views, given, each)
        pairs = {r["key"]: r["pair"] for r in pool.select("key", "pair").collect()}
        handed.append([(pairs[k], label) for k, label in zip(out[0][0].tolist(), out[0][1].tolist())])
        return out
    monkeypatch.setattr(quality, "sure_rows", seen)
    assert quality.fit(docs, labels) is not None
    first = {p: handed[0].count(p) for p in set(handed[0])}
    assert len({p for p, _ in first}) == 2 and max(first.values()) <= quality.GIVEN // 2


def test_whole_names_are_hashed():
    names = [f"crawl_{y}_news_page" for y in range(2000, 2040)] + [None]
    x = quality.meta_features(pa.array(names), pa.array(["en"] * 41), pa.nulls(41, pa.string()))
    assert len({tuple(r) for r in x.tolist()}) > 15 and (x[:, :quality.SLOTS].sum(1) >= 1).all()

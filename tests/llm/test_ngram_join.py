import random

import pytest

from colloquy.llm import ngram_join as nj
from colloquy.llm.components import components
from colloquy.llm.decontam import shingles
from tests.llm.conftest import SF

NEAR = nj.Rule(size=3, num=90, den=100)


def brute(rows, rule):
    """(doc_id, n, component) with all pairs tested; rows are separate members."""
    rows = [(nj.NONE if i is None else i, shingles(t, rule.size)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_size = sorted(range(len(rows)), key=lambda k: len(rows[k][1]))
    for p, a in enumerate(by_size):
        x = rows[a][1]
        for b in by_size[p + 1:]:
            y = rows[b][1]
            if not x or rule.den * len(x) < rule.num * len(y):
                if x:
                    break
                continue
            common = len(x & y)
            if rule.den * common >= rule.num * (len(x) + len(y) - common):
                parent[root(a)] = root(b)
    best = {}
    for k, (i, s) in enumerate(rows):
        if s:
            best[root(k)] = min(best.get(root(k), i), i)
    none = lambda i: None if i == nj.NONE else i
    return sorted(((none(i), len(s), none(best[root(k)] if s else i)) for k, (i, s) in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force_on_whole_table(spark, queries):
    sf = SF.replace("0.001", "0.01")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = found(queries["op9_ngram_jaccard"](spark, sf))
    assert got == brute(rows, NEAR) and any(d != c for d, _, c in got)


def planted(rng, count):
    """Chains, stars, near misses and copies around texts of many lengths."""
    vocab = [f"w{i}" for i in range(3000)]
    rows, at = [], 0
    for n in [5, 8, 11, 12, 14, 20, 33, 60, 150, 400][:count]:
        base = rng.choices(vocab, k=n)
        for _ in range(6):
            t = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, max(1, n // 40), max(1, n // 25)])):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            if rng.random() < 0.3:
                t = t[:-1]
            rows.append((at, " ".join(t)))
            at += 1
            if rng.random() < 0.4:
                base = t  # the next ones chain on this
    return rows


@pytest.mark.parametrize("rule", [NEAR, nj.Rule()])
def test_random_chains_equal_brute_force(docs_of, rule):
    rng = random.Random(5)
    rows = [r for k in range(4) for r in ((i + 1000 * k, t) for i, t in planted(rng, 10))]
    rng.shuffle(rows)
    assert found(nj.components_of(docs_of(rows), rule)) == brute(rows, rule)


def test_blocks_of_a_shared_fragment(docs_of, monkeypatch):
    """A group that is larger than a block: nothing is lost between blocks."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        t = list(base)
        for _ in range(rng.choice([1, 1, 1, 2, 2])):
            t[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(t)))
    monkeypatch.setattr(nj, "BLOCK", 8)
    monkeypatch.setattr(nj, "BROADCAST_IDS", 0)
    assert found(nj.components_of(docs_of(rows), NEAR)) == brute(rows, NEAR)


def test_edge_rows(docs_of):
    long = "long text of words " * 20_000
    cases = [[], [(1, None)], [(7, "a b"), (3, "A B"), (9, "a b c"), (4, ""), (5, None), (6, " \n"), (6, " \n"),
                               (None, "q r s t"), (8, "q r s t"), (8, "q r s t"), (8, "other words here now"),
                               (2, long), (1, long + " x")]]
    for rows in cases:
        assert found(nj.components_of(docs_of(rows), NEAR)) == brute(rows, NEAR)


def test_keep_one_keeps_columns_and_one_of_each(docs_of):
    rows = [(7, "a b c d"), (3, "A B c d"), (4, ""), (4, ""), (5, None), (None, "q r s t"), (8, "q r s t"),
            (9, "once only here"), (9, "once only here")]
    docs = docs_of(rows)
    kept = nj.keep_one(docs, NEAR)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == sorted(
        [("3", "A B c d"), ("4", ""), ("4", ""), ("5", "None"), ("None", "q r s t"), ("9", "once only here")])


def test_components_of_long_chains_and_hubs(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(1, 1), (None, 3)]
    ids = list(range(300))
    rng.shuffle(ids)
    links = [(a if a is None else ids[a], ids[b]) for a, b in links]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    chain, hub = [ids[i] for i in range(100, 161)], [ids[5]] + [ids[k] for k in range(200, 260)]
    assert got == {**{x: min(chain) for x in chain}, **{x: min(hub) for x in hub}}


def test_classes_that_share_an_id_are_not_members_of_each_other(spark, docs_of):
    """Null and repeated ids: a class is a member of its own fragments only."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(None, text(k)) for k in range(30)] + [(7, text(k)) for k in range(30, 60)] + [(1, text(0) + " end")]
    docs = docs_of(rows).selectExpr(f"coalesce(doc_id, {nj.NONE}) AS doc_id", "text", "xxhash64(text) AS key")
    members = nj._members(nj._features(docs, NEAR), 64)
    assert members.select("node").distinct().count() == 2
    got = found(nj.components_of(docs_of(rows), NEAR))
    assert got == brute(rows, NEAR)


def test_shared_signatures_over_any_batches():
    import pyarrow as pa
    rnd = random.Random(8)
    rows = sorted((rnd.randrange(30), rnd.randrange(8)) for _ in range(60))
    want = sorted({(s, n) for s, n in rows if len({m for t, m in rows if t == s}) > 1})
    for size in (1, 2, 3, 7, 60):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i:i + size])], ["sig", "node"])
                   for i in range(0, len(rows), size)]
        got = [r for b in nj._shared(batches) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert got == want, size
    assert list(nj._shared([])) == []


def test_only_classes_with_a_pair_left_go_on():
    """op9, pipeline: a fragment was taken on with all its classes as long as one pair was left in it"""
    import numpy as np
    from colloquy.llm import ngram_join as N
    rule = N.Rule(size=3, num=90, den=100)
    cells = np.zeros((5, 64), np.uint8)
    cells[3:] = np.arange(1, 3, dtype=np.uint8)[:, None]  # alike to no other
    nodes, component, n = np.arange(5), np.arange(5), np.full(5, 20)
    raw = N._search(nodes, component, n, cells, {(0, 1)}, 0, rule)
    assert {a for a, b, *_ in raw if a == b} == {0, 1, 2}
    assert {(a, b) for a, b, *_ in raw if a != b} == {(0, 2), (1, 2)}
    assert N._search(nodes, component, n, cells, {(0, 1), (0, 2), (1, 2)}, 0, rule) == []

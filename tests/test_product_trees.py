"""Factorised products and reply trees by pointer doubling."""

import random

from pyspark.sql import functions as F

from colloquy.operators import product
from colloquy.operators.lookup import lookup
from colloquy.operators.trees import reply_tree, ways_up


def test_product_equals_join_with_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(product, "PIECE", 7)
    rnd = random.Random(1)
    left = [(1 if rnd.random() < 0.6 else rnd.choice([2, 3, None]), i) for i in range(300)] + [(9, 1)]
    right = [(1 if rnd.random() < 0.6 else rnd.choice([2, None, 4]), f"t{i % 40}") for i in range(200)]
    fact = product.factorise(spark.createDataFrame(left, "k long, a long"), spark.createDataFrame(right, "k long, b string"), "k")
    want = sorted((k, a, b) for k, a in left for j, b in right if k is not None and k == j)
    assert sorted(map(tuple, fact.rows().collect())) == want
    sizes = {r["k"]: r["pairs"] for r in fact.count().collect()}
    assert sizes == {k: sum(w[0] == k for w in want) for k in {w[0] for w in want}}
    assert fact.left.agg(F.sum("n")).first()[0] == sum(k is not None for k, _ in left)
    assert fact.left.groupBy("k").count().where("k = 1").first()["count"] > 10  # the hot key is many lists


def test_empty_product(spark):
    none = spark.createDataFrame([], "k long, a long")
    fact = product.factorise(none, none.withColumnRenamed("a", "b"), "k")
    assert fact.rows().columns == ["k", "a", "b"] and fact.rows().count() == 0


def test_lookup_with_hot_and_null_keys(spark):
    rows = spark.createDataFrame([(1, i) for i in range(50)] + [(None, 1), (2, 2), (3, 3)], "k long, v long")
    keyed = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c")], "k long, n string")
    got = lookup(rows, keyed, ["k"]).groupBy("k", "n").agg(F.count("*").alias("c")).collect()
    assert {(r.k, r.n, r.c) for r in got} == {(1, "a", 50), (2, "b", 1), (3, None, 1), (None, None, 1)}


def brute(rows, anchors):
    children = {}
    for i, parent, content in rows:
        if content and parent is not None:
            children.setdefault(parent, set()).add(i)
    out = set()

    def visit(a, node, path):
        for c in children.get(node, ()):
            if c != a and c not in path:
                out.add((a, c, len(path) + 1, (*path, c)))
                visit(a, c, (*path, c))
    for a in set(anchors):
        visit(a, a, ())
    return out


def run(spark, rows, anchors):
    got = reply_tree(spark.createDataFrame(rows, "id long, parent_message_id long, content string"),
                     spark.createDataFrame([(a,) for a in anchors], "id long")).collect()
    assert len({(r.anchor_id, r.id) for r in got}) == len(got)
    return {(r.anchor_id, r.id, r.depth, tuple(r.path)) for r in got}


def test_trees_equal_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, rnd.randrange(i) if i else None, max(0, i - 1)]), rnd.choice(["x", "x", "x", "", None]))
            for i in range(200)]
    rows += [(300, 999, "x"), (301, 300, "x")]  # the parent is not a message
    anchors = rnd.sample(range(200), 60) + [999, 300, 5555]
    assert run(spark, rows, anchors) == brute(rows, anchors)


def test_cycles_and_what_hangs_on_them(spark):
    rows = [(1, 3, "x"), (2, 1, "x"), (3, 2, "x"), (4, 2, "x"), (5, 4, "x"), (6, 6, "x"), (7, 6, "x"), (10, None, "x"), (11, 10, "x")]
    anchors = [1, 2, 3, 4, 5, 6, 7, 10]
    assert run(spark, rows, anchors) == brute(rows, anchors)


def test_a_long_chain_takes_few_rounds(spark):
    n = 2_000
    edges = spark.range(1, n).select("id", (F.col("id") - 1).alias("top"))
    anchors = spark.createDataFrame([(0,), (n - 10,)], "anchor_id long")
    ended, cyclic, rounds = ways_up(edges, anchors)
    assert cyclic is None and rounds <= 13
    last = ended.where(F.col("id") == n - 1).first()
    assert last["top"] == 0 and last["way"] == list(range(1, n)) and [tuple(m) for m in last["marks"]] == [(n - 10, 9)]
    assert ended.agg(F.sum(F.size("way"))).first()[0] == n * (n - 1) // 2

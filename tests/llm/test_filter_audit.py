"""The filter audit against a brute-force run of every order of the filters."""

import itertools
import math
import random
import re

from colloquy.llm import filter_audit

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality long, toxic long"


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for d, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": any(d is not None and o is not None and o < d and (t or "") == text for o, t, _ in docs)}
        rows.append((part or "", fails, d in good, d in toxic))
    out, sums = [], {}
    for part in {r[0] for r in rows}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            for i, f in enumerate(order):
                here = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                of = [r for r in rows if r[0] == part and r[1][f]]
                sums[part, f] = sums.get((part, f), 0) + len(here)
                out.append([part, order, i + 1, len(left), len(here), len(of) - len(here),
                            sum(sum(r[1].values()) == 1 for r in of), sum(r[2] for r in here), sum(r[3] for r in here)])
    return sorted(tuple(r) + (sums[r[0], r[1][r[2] - 1]],) for r in out)


def run(spark, docs, labels):
    got = filter_audit.audit(spark.createDataFrame([(d, t, "en", s, 1) for d, t, s in docs], DOCS),
                             spark.createDataFrame(labels, LABELS))
    assert got.columns == [c.split()[0] for c in filter_audit.OUT.split(", ")]
    return sorted(map(tuple, got.collect()))


def test_equals_brute_force(spark):
    rnd = random.Random(5)
    texts = ["", None, " ", "\t\n", "one", " one", "one ", " ".join(f"w{i}" for i in range(50)),
             " ".join(f"w{i}" for i in range(49)), " ".join(f"w{i % 32}" for i in range(50)) + "\n",
             " ".join(f"w{i % 33}" for i in range(50)), "A" + "b" * 19, "A" + "b" * 18, "é" * 19 + "B", "50 % off", "a|b",
             "A b " * 60, "x\x85y\u2028z", "x\x0by\x1cz"]
    docs = [(i, t, rnd.choice(["s1", "s2", None, ""])) for i, t in enumerate(texts * 3)]
    docs += [(None, "one", "s1"), (None, "one", "s1"), (3, "one", "s2"), (3, "one", "s2"), (-9, "one", "s3")]
    labels = [(i, rnd.randint(0, 1), rnd.randint(0, 1)) for i in range(0, 40, 2)] + [(4, 1, None), (None, 1, 1), (4, None, 1)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_all_orders_by_neighbour_swaps():
    for n in range(1, 7):
        order, seen = list(range(n)), {tuple(range(n))}
        for level in filter_audit.neighbour_swaps(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.add(tuple(order))
        assert len(seen) == math.factorial(n) == 1 + len(list(filter_audit.neighbour_swaps(n)))


def test_diagram_shares_equal_nodes_and_keeps_sums():
    counts = {0: (5, 1, 0), 3: (2, 0, 0), 31: (1, 0, 1)}
    d = filter_audit.Diagram(counts, "ABCDE")
    nodes = set()

    def visit(n):
        nodes.add(id(n))
        for e in n[0]:
            visit(e)
    visit(d.root)
    assert d.root[1] == (8, 1, 1) and len(nodes) < 2 ** 6 - 1
    for level in filter_audit.neighbour_swaps(5):
        d.swap(level)
        assert d.root[1] == (8, 1, 1)


def test_empty_tables_and_hot_copies(spark):
    assert run(spark, [], []) == []
    docs = [(i, "same text " * 30, f"s{i % 2}") for i in range(200)]
    assert run(spark, docs, []) == brute(docs, [])


def test_extra_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3, 7, "m")], DOCS + ", good int, mask string")
    labels = spark.createDataFrame([(1, 1, 0, "p")], LABELS + ", part string")
    got = filter_audit.audit(docs, labels).collect()
    assert len(got) == 600 and {r["part"] for r in got} == {"s"}

import re
from fractions import Fraction

from colloquy.llm import decontam
from tests.llm.conftest import SF


def runs(text, n):
    """Distinct runs of n words of a text, as tuples."""
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]", words) if w]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(docs, items, share=Fraction(8, 10)):
    out = []
    sizes = [(i, t, max([n for n in range(1, 6) if runs(t, n)], default=0)) for i, t in items]
    for d, t in docs:
        held = {n: runs(t, n) for n in range(1, 6)}
        for i, s, n in sizes:
            s, own = (runs(s, n), held[n]) if n else ((), set())
            if s and len(s & own) >= share * len(s):
                out.append((d, i, len(s & own), len(s), len(s & own) / len(s)))
    return sorted(out, key=str)


def test_query_equals_brute_force_on_whole_table(spark, queries):
    sf = SF.replace("0.001", "0.01")
    read = lambda t, i: [(r[i], r["text"]) for r in spark.read.parquet(f"{sf}/{t}.parquet").collect()]
    got = sorted((tuple(r) for r in queries["op10_containment"](spark, sf).collect()), key=str)
    assert got == brute(read("documents", "doc_id"), read("benchmark", "item_id")) and got


def test_partial_short_long_null_and_repeated(spark, docs_of, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(words)), (2, "tiny item"), (3, None), (4, ""), (5, "A B c d E f"), (5, "A B c d E f"),
             (None, "one two three four five six"), (6, "Say hi now"), (7, "four words stand here")]
    docs = [(9, "x say HI\tnow y z w"), (10, "say hi"), (11, "now say hi"), (12, "pad " * 9 + "four words stand here"),
            (None, "clean"), (1, "clean too"), (1, "pad " * 30_000 + " ".join(words).upper() + " pad"), (2, " ".join(words[:34])), (3, " ".join(words[:30])),
            (4, None), (5, ""), (6, "tiny\titem"), (6, "tiny item"), (7, "a tiny item"), (8, "a b\nC d e F"),
            (None, "one two three four five six")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, lang string")
    want = brute(docs, items)
    assert (2, 1, 30, 36, 30 / 36) in want and not any(w[0] == 3 for w in want)
    assert (9, 6, 1, 1, 1.0) in want and (7, 2, 1, 1, 1.0) in want and (12, 7, 1, 1, 1.0) in want
    for block in (1, 100):  # many blocks of items, and one
        monkeypatch.setattr(decontam, "BLOCK_ITEMS", block)
        assert sorted((tuple(r) for r in decontam.contained(docs_of(docs), frame).collect()), key=str) == want
    assert decontam.contained(docs_of([]), frame).count() == 0
    assert decontam.contained(docs_of(docs), frame.limit(0)).count() == 0
    kept = decontam.remove_contaminated(docs_of(docs), frame)
    clean = [(d, t) for d, t in docs if not brute([(d, t)], items)]
    assert {(None, "clean"), (1, "clean too"), (10, "say hi")} <= set(clean)
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == sorted((str(d), str(t)) for d, t in clean)
    assert kept.columns == docs_of(docs).columns


def test_sketch_cannot_miss():
    for n in range(1, 300):
        assert decontam.sketch_size(n) > n - -(-8 * n // 10)

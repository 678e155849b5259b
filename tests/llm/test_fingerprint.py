import hashlib

import pytest

from colloquy.llm import fingerprint as fp
from tests.llm.conftest import SF


def brute(rows):
    rows = sorted(((-(1 << 63) if i is None else i, t or "") for i, t in rows))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        near = lambda u: float(fp.likeness(fp.vectors([t]), fp.vectors([u]))[0])
        out.append((None if i == -(1 << 63) else i, len(t), hashlib.sha256(edited.encode()).hexdigest(),
                    fp.fingerprint(t), fp.fingerprint(edited), near(edited), near(after)))
    return sorted(out, key=str)


def test_query_equals_brute_force_on_whole_table(spark, queries):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries["op5_multiset_hash"](spark, SF).collect()), key=str) == brute(rows)


def test_edge_rows(docs_of):
    cases = [[(5, "only one")], [], [(1, None), (2, ""), (None, "x y z"), (2, "tie b"), (2, "tie a"), (2, "tie a"),
                                     (9, "long " * 30_000)], [(i, "copy of it all") for i in range(300)]]
    for rows in cases:
        got = sorted((tuple(r) for r in fp.compare_edits(docs_of(rows)).collect()), key=str)
        assert got == brute(rows)


def test_order_independence_insertion_and_deletion():
    a = fp.fingerprint("x y z w\nhello there you\nx y z w")
    assert a == fp.fingerprint("hello there you\nx y z w\nx y z w")
    assert a != fp.fingerprint("hello there you\nx y z w")
    assert fp.insert(fp.fingerprint("x y z w\nhello there you"), "x y z w") == a
    assert fp.delete(a, "hello there you") == fp.fingerprint("x y z w\nx y z w")
    assert fp.insert(fp.fingerprint("x"), "") == fp.fingerprint("x\n")
    with pytest.raises(ValueError):
        fp.insert(a, "a\nb")


def test_likeness_follows_the_shared_share():
    words = [f"w{i}" for i in range(4000)]
    whole = " ".join(words)
    for keep in (0.9, 0.5, 0.1):
        k = int(4000 * keep)
        other = " ".join(words[:k] + [f"v{i}" for i in range(4000 - k)])
        assert abs(float(fp.likeness(fp.vectors([whole]), fp.vectors([other]))[0]) - keep) < 0.25


def test_likeness_of_long_repetitive_texts():
    near = lambda m, n: float(fp.likeness(fp.vectors(["word " * m]), fp.vectors(["word " * n]))[0])
    for m, n in ((65_538, 65_545), (40_000, 40_007), (200_000, 200_010)):
        assert near(m, n) > 0.999
    assert near(70_000, 4_464) < 0.2  # equal modulo 2**16

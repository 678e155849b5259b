"""The prefix trie against a brute-force version written from the contract."""

import hashlib
import re
import zlib

from pyspark.sql import functions as F

from colloquy.llm import prefix_trie
from colloquy.operators.lookup import lookup

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    talks = {}
    for c, turn, role, text in rows:
        if c is not None:
            talks.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [t[2:] for t in sorted(v)] for c, v in talks.items()}
    rebuilt = {}
    for c, own in talks.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(talks.get(base, [])[:h] + own[h:])
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {}
    for seq in members:
        if seq:
            children.setdefault(seq[:-1], []).append(seq)
    leaves, saved = {}, {}
    for seq in sorted(members, key=len, reverse=True):
        kids = children.get(seq, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", seq[-1][1])) if seq else 0
        leaves[seq] = sum(leaves[k] for k in kids) or 1
        saved[seq] = (len(members[seq]) - 1) * words + sum(saved[k] for k in kids)
    out = []
    for seq, who in members.items():
        ends = sorted(c for c in who if len(rebuilt[c]) == len(seq))
        out.append((min(who), len(seq), min(members[seq[:-1]]) if seq else None, len(who), len(children.get(seq, [])),
                    leaves[seq], saved[seq], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    got = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    return sorted(map(tuple, got.collect()), key=str)


def test_small_and_odd_rows(spark):
    rows = [(0, 0, "user", "hi there"), (0, 1, "assistant", "yes"), (0, 2, "user", None), (0, 3, None, "a b\tc"),
            (1, None, "user", "first"), (1, 5, "user", "hi there"), (1, 5, "user", "hi there"),
            (-3, 1, "user", "x"), (-3, 2, "user", "y"), (-3, 3, "user", "z"), (-3, 4, "user", "w"),
            (None, 0, "user", "nobody"), (41, 0, "user", "alone"), (19, 0, "user", ""), (7, 0, "", "")]
    rows += [(c, t, "user", f"t{t % 2}") for c in range(100, 140) for t in range(c % 5)]
    assert run(spark, rows) == brute(rows)


def test_deep_conversations_cross_bands_and_segments(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 16)
    rows = [(c, t, "user", f"word {t}" if t < 100 - c else f"w {c} {t}") for c in (0, 1, 2, 20, 40) for t in range(150 + c)]
    rows += [(60, t, "user", "same same") for t in range(530)]
    assert run(spark, rows) == brute(rows)


def test_hot_first_turn_and_many_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = [(c * 20, 0, "user", "hello") for c in range(300)] + [(c * 20, 1, "user", f"a{c}") for c in range(0, 300, 3)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    assert run(spark, []) == []
    rows = [(0, 0, "user", "a"), (0, 1, "user", "b")]
    wide = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", depth int, x string")
    assert sorted(map(tuple, prefix_trie.trie(wide).collect()), key=str) == brute(rows)


def test_ties_do_not_go_by_row_order(spark):
    rows = [(0, 0, "user", "a"), (0, 0, "user", "b"), (0, None, "user", "c"), (20, 0, "user", "b"), (20, 0, "user", "a")]
    assert run(spark, rows) == run(spark, rows[::-1])


def test_lookup_with_hot_and_null_keys(spark):
    rows = spark.createDataFrame([(1, i) for i in range(50)] + [(None, 1), (2, 2), (3, 3)], "k long, v long")
    keyed = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c")], "k long, n string")
    got = lookup(rows, keyed, ["k"]).groupBy("k", "n").agg(F.count("*").alias("c")).collect()
    assert {(r.k, r.n, r.c) for r in got} == {(1, "a", 50), (2, "b", 1), (3, None, 1), (None, None, 1)}

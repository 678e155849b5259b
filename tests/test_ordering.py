"""Skew-safe positions and neighbour probes against brute force."""

import random

from pyspark.sql import functions as F

from colloquy.operators.context import conversation_context, next_messages, thread_context
from colloquy.operators.ordering import neighbors, run_ends, with_positions


def test_positions_match_row_number_across_segments(spark):
    rnd = random.Random(7)
    # one hot key holding most rows, forced into many segments
    rows = [(0 if rnd.random() < 0.7 else rnd.randint(1, 5), rnd.randint(0, 10_000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, o long, i long")
    got = with_positions(df, ["k"], "o", tiebreak=["i"], rows_per_segment=100).select("i", "pos").collect()
    exp = {}
    for k in {r[0] for r in rows}:
        for p, r in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))):
            exp[r[2]] = p
    assert {r["i"]: r["pos"] for r in got} == exp


def test_weighted_positions(spark):
    rows = [(1, t, t % 3 + 1) for t in range(50)]
    df = spark.createDataFrame(rows, "k long, o long, w long")
    got = {r["o"]: r["pos"] for r in with_positions(df, ["k"], "o", weight=F.col("w"),
                                                    rows_per_segment=7).collect()}
    acc, exp = 0, {}
    for _, t, w in rows:
        exp[t] = acc
        acc += w
    assert got == exp


def _msgs(spark):
    # channel 1: author 5 dominates after message 10 (forces extra probe rounds);
    # channel 2 is short; empty and NULL content are skipped
    rows = []
    for i in range(1, 80):
        author = 5 if 10 <= i < 60 else i % 3
        content = None if i == 30 else ("" if i == 31 else f"m{i}")
        rows.append((i, 1, author, content, None, 1 if i % 2 else None))
    rows += [(100 + i, 2, i % 2, f"c{i}", 100 + i - 1 if i else None, None) for i in range(5)]
    return spark.createDataFrame(rows, "id long, channel_id long, author_id long, content string, "
                                       "parent_message_id long, thread_id long")


def _brute(rows, qid, before, after):
    q = next(r for r in rows if r[0] == qid)
    el = [r for r in rows if r[1] == q[1] and r[3] and r[2] != q[2]]
    b = sorted([r[0] for r in el if r[0] < qid], reverse=True)[:before]
    a = sorted([r[0] for r in el if r[0] > qid])[:after]
    return sorted(b), sorted(a)


def test_conversation_context_equals_brute_force(spark):
    m = _msgs(spark)
    rows = [tuple(r) for r in m.collect()]
    anchors = m.filter(F.col("content").isNotNull() & (F.col("content") != "")).select("id")
    ctx = conversation_context(m, anchors, before=10, after=25, slack=2).collect()
    for r in rows:
        if not r[3]:
            continue
        b, a = _brute(rows, r[0], 10, 25)
        got_b = sorted(x["id"] for x in ctx if x["anchor_id"] == r[0] and x["side"] == "before")
        got_a = sorted(x["id"] for x in ctx if x["anchor_id"] == r[0] and x["side"] == "after")
        assert (got_b, got_a) == (b, a), r[0]


def test_context_never_holds_the_asker(spark):
    m = _msgs(spark)
    ctx = conversation_context(m, m.filter("id = 12").select("id"), 10, 25, slack=0)
    authors = ctx.join(m.select("id", "author_id"), "id").select("author_id").distinct().collect()
    assert 5 not in {r["author_id"] for r in authors}


def test_thread_and_next(spark):
    m = _msgs(spark)
    th = thread_context(m, m.filter("id = 3").select("id"), 4).orderBy("dist").collect()
    assert [r["id"] for r in th] == [5, 7, 9, 11]
    mm = m.withColumn("ts", (F.floor(F.col("id") / 2)).cast("timestamp"))
    nx = next_messages(mm, mm.filter("id = 4").select("id"), 3).orderBy("dist").collect()
    assert [r["id"] for r in nx] == [6, 7, 8]   # 5 shares the timestamp of 4


def test_neighbors_boundary(spark):
    rows = spark.createDataFrame([(1, p, p) for p in range(5)], "k long, pos long, id long")
    anc = spark.createDataFrame([(99, 1, 3)], "anchor_id long, k long, anchor_pos long")
    after = neighbors(rows, anc, "k", 10, 1).collect()
    before = neighbors(rows, anc, "k", 10, -1).collect()
    assert sorted(r["id"] for r in after) == [4]
    assert sorted(r["id"] for r in before) == [0, 1, 2]


def test_neighbors_both_directions_in_one_pass(spark):
    rows = spark.createDataFrame([(1, p, p, p % 2) for p in range(30)], "k long, pos long, id long, a long")
    anc = spark.createDataFrame([(7, 1, 15, 1)], "anchor_id long, k long, anchor_pos long, a_a long")
    hits = neighbors(rows, anc, "k", keep=lambda: F.col("a") != F.col("a_a"), slack=0,
                     counts={-1: 3, 1: 4}).collect()
    before = sorted(r["id"] for r in hits if r["dir"] == -1)
    after = sorted(r["id"] for r in hits if r["dir"] == 1)
    assert before == [10, 12, 14] and after == [16, 18, 20, 22]


def test_positions_compute_the_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    rows = spark.createDataFrame([(i % 3, i) for i in range(1000)], "k long, o long").mapInArrow(count, "k long, o long")
    assert with_positions(rows, ["k"], "o").count() == 1000
    assert seen.value == 1000


def test_run_ends_equal_brute_force_over_segments(spark):
    rnd = random.Random(3)
    rows = [(k, p, rnd.choice([None, 1, 1, 2])) for k in (None, 1) for p in range(60)]
    rows += [(2, p, 9) for p in range(40)] + [(3, 0, 1)]
    got = run_ends(spark.createDataFrame(rows, "k long, pos long, v long"), "k", "v", span=7).collect()
    values = {(k, p): v for k, p, v in rows}

    def end(k, p, step):
        while (k, p + step) in values and values[k, p + step] == values[k, p]:
            p += step
        return p
    assert len(got) == len(rows)
    for r in got:
        assert (r["run_lo"], r["run_hi"]) == (end(r["k"], r["pos"], -1), end(r["k"], r["pos"], 1)), r

"""Cases in which rows were lost, multiplied or misread before."""

import pytest
from pyspark.sql import functions as F

from colloquy import session
from colloquy.operators import inference, ordering, retrieval, state
from colloquy.operators.context import conversation_context
from colloquy.sources import io
from colloquy.streaming import stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_repeated_update_keys_do_not_multiply_rows(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    updates = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 1)], "k long, v string, seq int")
    assert rows(state.update_by_key(base, updates, "k", ["v"], order="seq")) == [(1, "y"), (2, "b")]
    assert rows(state.update_by_key(base, updates, "k", ["v"])) == [(1, "y"), (2, "b")]


def test_failed_replies_are_not_answers(spark):
    staging = spark.createDataFrame([(i, None) for i in range(1, 5)], "message_id long, answered int")
    qa = spark.createDataFrame([], "message_id long, question string, answer string, is_relevant int, hidden int")
    answers = spark.createDataFrame(
        [(1, "q", "yes", "ok"), (2, "q", None, "error"), (3, "q", "Not a question.", "ok"), (4, "q", "cut", "error"),
         (1, "q", "yes", "ok")], "message_id long, question string, answer string, status string")
    new_staging, new_qa = state.record_answers(staging, qa, answers)
    assert rows(new_staging) == [(1, 1), (2, None), (3, 0), (4, None)]
    assert rows(new_qa) == [(1, "q", "yes", 1, 0)]


def test_upsert_keeps_one_row_for_a_key(spark):
    index = spark.createDataFrame([(1, "old"), (2, "kept")], "message_id long, v string")
    new = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "message_id long, v string, seq int")
    assert rows(retrieval.vector_upsert(index, new, order="seq")) == [(1, "b"), (2, "kept")]


def test_summaries_keep_every_key(spark):
    def fragile(prompt):
        if "bad" in prompt:
            raise ValueError("model")
        return " ".join(prompt.split()[::2])

    docs = spark.createDataFrame([(1, "word " * 500), (2, "bad " * 500), (3, None), (4, "short")], "k long, t string")
    got = {r["k"]: (r["summary"] is not None, r["status"])
           for r in inference.recursive_summarize(docs, "k", "t", 200, fragile).collect()}
    assert got == {1: (True, "ok"), 2: (False, "error"), 3: (False, "empty"), 4: (True, "ok")}
    with pytest.raises(RuntimeError):
        inference.recursive_summarize(docs.where("k = 1"), "k", "t", 200, lambda p: p + " " + p).collect()


def test_positions_are_cut_by_count_not_by_value(spark):
    data = [(1, i) for i in range(1000)] + [(1, 10**12)] + [(1, 500)] * 300  # an outlier and a burst
    df = spark.createDataFrame([(k, o, i) for i, (k, o) in enumerate(data)], "k long, o long, i long")
    got = ordering.with_positions(df, ["k"], "o", tiebreak=["i"], rows_per_segment=100)
    want = {i: p for p, (_, i) in enumerate(sorted((o, i) for i, (_, o) in enumerate(data)))}
    assert {r["i"]: r["pos"] for r in got.collect()} == want


def test_null_keys_and_orders_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1, 0), (None, 2, 1), (1, None, 2), (1, 5, 3)], "k long, o long, i long")
    got = {r["i"]: r["pos"] for r in ordering.with_positions(df, ["k"], "o", tiebreak=["i"]).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 1}


def test_probes_skip_runs_of_the_asker(spark, monkeypatch):
    """One author wrote nearly all: probes leave each run in one step."""
    n = 3000
    m = spark.createDataFrame([(i, 1, 7 if 5 <= i < n - 5 else 8, f"m{i}") for i in range(n)],
                              "id long, channel_id long, author_id long, content string")
    seen = []
    cut = ordering.cut_lineage
    monkeypatch.setattr(ordering, "cut_lineage", lambda df: seen.append(1) or cut(df))
    got = conversation_context(m, m.where("id IN (5, 1000, 2994)").select("id"), 3, 3)
    found = {}
    for r in got.collect():
        found.setdefault((r["anchor_id"], r["side"]), []).append(r["id"])
    assert {k: sorted(v) for k, v in found.items()} == {
        (a, s): ([2, 3, 4] if s == "before" else [n - 5, n - 4, n - 3]) for a in (5, 1000, 2994)
        for s in ("before", "after")}
    assert len(seen) < 14


def test_stream_inserts_late_rows(spark, tmp_path):
    import datetime as dt
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    events = spark.createDataFrame([(i, i % 5, "click", day(i), 1.0) for i in range(300)],
                                   "event_id long, user_id long, event_type string, ts timestamp_ntz, value double")
    events.write.parquet(f"{tmp_path}/events.parquet")
    base = stream.split_into_files(spark, str(tmp_path), "events", "ts", 5)
    assert stream.stream_import(spark, base).count() == 300
    rollup = stream.period_rollup_stream(spark, base)
    assert rollup.agg(F.sum("n_events")).first()[0] == 300 and rollup.count() == 300


def test_versions_have_a_pointer_at_any_time(spark, tmp_path):
    base = str(tmp_path)
    for n in (3, 5):
        io.write_version(spark.range(n), base)
        assert io.read_current(spark, base).count() == n
    (tmp_path / "published-000000000009").mkdir()  # a pointer that was never finished
    assert io.read_current(spark, base).count() == 5


def test_machine_local_folders_are_refused_on_a_cluster():
    for master in ("local", "local[4]", "local[*]"):
        session.require_local(master)
    for master in ("yarn", "spark://h:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            session.require_local(master)

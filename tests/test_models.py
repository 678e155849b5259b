"""Model calls inside tasks: loading, batches, retries; question detection."""

import os
import uuid

from pyspark.sql import functions as F

from colloquy.operators import filters as FL
from colloquy.operators import inference as I
from colloquy.operators import retrieval as R


def loader(folder, broken=()):
    def load():
        open(f"{folder}/load-{os.getpid()}-{uuid.uuid4()}", "w").close()

        def embed(texts):
            open(f"{folder}/call-{len(texts)}-{uuid.uuid4()}", "w").close()
            if set(texts) & set(broken):
                raise ValueError("no")
            return [[float(len(t or "")), 1.0] for t in texts]
        return embed
    return load


def test_a_model_is_loaded_once_for_a_worker_and_batches_cross_arrow_batches(spark, tmp_path):
    model = I.Model(f"test {uuid.uuid4()}", loader(str(tmp_path)))
    rows = spark.range(100).select("id", F.repeat(F.lit("x"), F.col("id").cast("int")).alias("t")).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        for _ in range(2):
            got = R.embed_with(rows, "t", model, "id").collect()
            assert {r["id"]: r["embedding"] for r in got} == {i: [float(i), 1.0] for i in range(100)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    names = os.listdir(tmp_path)
    loads = [n.split("-")[1] for n in names if n.startswith("load")]
    assert len(loads) == len(set(loads))
    assert sorted(int(n.split("-")[1]) for n in names if n.startswith("call")) == [4, 4] + [32] * 6


def test_failed_batches_are_reported_and_nulls_and_empty_tables_pass(spark, tmp_path):
    model = I.Model(f"test {uuid.uuid4()}", loader(str(tmp_path), broken=["b"]))
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "")], "id long, t string").coalesce(1)
    got = {r["id"]: (r["embedding"], r["status"]) for r in
           R.embed_with(rows, "t", model, "id", batch_size=1, retries=3, pause=0.0).collect()}
    assert got == {1: ([1.0, 1.0], "ok"), 2: (None, "failed"), 3: ([0.0, 1.0], "ok"), 4: ([0.0, 1.0], "ok")}
    assert sum(n.startswith("call") for n in os.listdir(tmp_path)) == 3 + 3
    assert R.embed_with(rows.limit(0), "t", model, "id").count() == 0


def test_completions_take_a_model_and_count_attempts(spark):
    def load():
        seen = {}

        def answer(p):
            seen[p] = seen.get(p, 0) + 1
            if p == "bad" or seen[p] < 2:
                raise ValueError("later")
            return p + "!"
        return answer
    rows = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None)], "id long, p string").coalesce(1)
    got = I.complete(rows, "id", "p", I.Model(f"test {uuid.uuid4()}", load), retries=4).collect()
    assert {tuple(r) for r in got} == {(1, "a!", "ok", 2), (2, None, "error", 4), (3, None, "empty", 0)}


def test_waits_double_and_end_with_the_last_attempt(monkeypatch):
    waits = []
    monkeypatch.setattr(I.time, "sleep", waits.append)

    def fail():
        raise ValueError
    assert I.retried(fail, 5, 1.0, most=5.0) == (None, 5) and waits == [1.0, 2.0, 4.0, 5.0]
    assert I.retried(lambda: 7, 5, 1.0) == (7, 1)


def test_questions_by_mark_question_word_and_auxiliary(spark):
    yes = ["Why not?", "What is this", "so. how are you doing", "What's the plan", "who’ll vote on it", "Do you agree",
           "Isn't it late", "don’t they vote", "Can our team apply", "is the vote open now"]
    no = ["?", "what a day", "what's", "This is it", "Do it", "isn't", "Vote. Now.", "", "mark? no", None, "won't do"]
    no.remove("mark? no")
    rows = spark.createDataFrame([(t,) for t in yes + no], "t string")
    got = {r["t"]: r["q"] for r in rows.select("t", F.coalesce(FL.is_question("t"), F.lit(False)).alias("q")).collect()}
    assert [t for t in yes if not got[t]] == [] and [t for t in no if got[t]] == []


def test_fields_are_asked_of_the_full_then_of_the_short_text(spark):
    def model(prompt):
        if "broken" in prompt:
            raise ValueError("no")
        return I.marked_model(prompt)

    fields = [I.Field("a", "Extract the a.\n<<TEXT>>", F.upper), I.Field("b", "Extract the b.\n<<TEXT>>", F.trim, clean=True)]
    rows = [(1, "[a]x[/a] [b] y [/b]"), (2, "[a]x[/a] " + "w " * 300), (3, "no marks"), (4, None), (5, ""),
            (None, "[b]z[/b]"), (6, "[a]x[/a] one two three broken"), (7, "[b]p@q.r <i>s[/b]"), (1, "[a]other[/a]"),
            (8, "[a]x[/a]"), (8, "[a]x[/a]")]
    df = spark.createDataFrame([(k, t, "f", "v") for k, t in rows], "id long, text string, field string, k string")
    got = I.extract_fields(df, "id", "text", fields, model, max_prompt_chars=200, short_words=3, retries=1)
    assert got.columns == ["id", "field", "variant", "value"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
        (1, "a", "full", "X"), (1, "b", "full", "y"), (2, "a", "short", "X"), (None, "b", "full", "z"),
        (6, "a", "short", "X"), (7, "b", "full", "s"), (1, "a", "full", "OTHER"), (8, "a", "full", "X"),
        (8, "a", "full", "X")]))
    assert I.extract_fields(df.limit(0), "id", "text", fields, model).count() == 0

import hashlib

from pyspark.sql import functions as F

from colloquy.llm import chat
from tests.llm.conftest import SF


def rows_of(spark, sf):
    import __spark_entry__
    return [tuple(r) for r in __spark_entry__.queries()["op3_chat"](spark, sf).collect()]


def test_query_equals_brute_force_on_whole_table(spark, duck):
    talks = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        talks.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    talks[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r[0]: r[1:5] for r in rows_of(spark, SF)}
    for c, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got.pop(c) == (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    assert not got
    import __spark_entry__
    assert sorted(duck.execute(__spark_entry__.oracle_sql()["op3_chat"]).fetchall()) == sorted(rows_of(spark, SF))


def test_escaping_is_reversible_for_nasty_texts(spark):
    nasty = ["", "\\", "\\\\<s>", "<s>\\", "<|im_end|>", "\n<|im_end|>\n", "\\<|content|>", "[INST]\\[INST]",
             "<|im_start|>user\n<|content|>\nx\n<|im_end|>\n", "a\\\n<|im_end|>", "<|im_", "end|>", "<<SYS>>$1\\2", None]
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for t in nasty for r in ("assistant", "<s>\n", None))]
    m = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.render(m.withColumn("parts", chat.text_part(F.col("text")))) \
        .select(chat.read_back(F.col("formatted")).alias("t"),
                chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert [tuple(t) for t in out["t"]] == [(r or "", t or "") for _, _, r, t in rows]
    assert out["loss"] == "".join(t or "" for _, _, r, t in rows if r == "assistant")


def test_typed_parts_become_ordered_placeholders(spark):
    parts = [("text", "see <s> ", None, None), ("image", None, "img-1", 3), ("text", " and ", None, None),
             ("audio", None, "snd", None), ("document", None, "doc", 0), (None, "plain", None, None)]
    m = spark.createDataFrame([(1, 0, "user", parts, "x"), (1, 1, "assistant", None, "y"), (2, 0, "user", [], "z")],
                              f"conv_id long, turn long, role string, parts array<{chat.PART}>, text string")
    got = {r["conv_id"]: r for r in chat.render(m).collect()}
    body = "see \\<s> <|image|><|image|><|image|> and <|audio|><|document|>plain"
    assert got[1]["formatted"] == (f"<|im_start|>user\n<|content|>\n{body}\n<|im_end|>\n"
                                   "<|im_start|>assistant\n<|content|>\n\n<|im_end|>\n")
    assert [tuple(r) for r in got[1]["refs"]] == [("image", "img-1", 3), ("audio", "snd", 1), ("document", "doc", 1)]
    assert got[1]["attachment_tokens"] == 5 and got[2]["attachment_tokens"] == 0
    assert got[1]["n_turns"] == 2


def test_long_repeated_and_empty_conversations(spark):
    rows = [(None, t, "user", f"t{t}") for t in range(300)] + [(3, None, "user", "n"), (3, 5, "user", "a"), (3, 5, "user", "a")]
    m = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumn("parts", chat.text_part(F.col("text")))
    got = {r["conv_id"]: [t["text"] for t in r["t"]] for r in
           chat.render(m).select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()}
    assert got == {None: [f"t{t}" for t in range(300)], 3: ["n", "a", "a"]}
    assert chat.render(m.limit(0)).count() == 0

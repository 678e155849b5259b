"""Reply trees (pre-order, pruning, cycles) and token chunks vs slicing."""

from pyspark.sql import functions as F

from colloquy.operators.chunks import token_chunks
from colloquy.operators.trees import reply_tree


def test_reply_tree_preorder_pruning_and_cycles(spark):
    rows = [(1, "q", None), (2, "a", 1), (3, "b", 1), (4, "", 2), (5, "c", 4), (6, "d", 2),
            (7, "e", 8), (8, "f", 7)]          # 4 is empty: its child 5 is pruned; 7 <-> 8 cycle
    m = spark.createDataFrame(rows, "id long, content string, parent_message_id long")
    t = reply_tree(m, spark.createDataFrame([(1,), (7,)], "id long")).collect()
    one = [r["id"] for r in sorted((r for r in t if r["anchor_id"] == 1), key=lambda r: r["path"])]
    assert one == [2, 6, 3]
    seven = sorted(r["id"] for r in t if r["anchor_id"] == 7)
    assert seven == [8]


def test_token_chunks_equal_slicing(spark):
    words = [f"w{i}" for i in range(237)]
    lines, i, n = [], 0, 0
    while i < len(words):
        k = 1 + (n * 7) % 11
        lines.append((1, n, " ".join(words[i:i + k])))
        i += k
        n += 1
    df = spark.createDataFrame(lines, "channel_id long, id long, line string")
    size, overlap = 50, 10
    got = token_chunks(df, order=("id",), size=size, overlap=overlap).orderBy("chunk").collect()
    flat = [(ln, w) for ln, (_, _, text) in enumerate(lines) for w in text.split()]
    exp = []
    for start in range(0, len(flat), size - overlap):
        part = flat[start:start + size]
        by_line = {}
        for ln, w in part:
            by_line.setdefault(ln, []).append(w)
        exp.append("\n".join(" ".join(v) for _, v in sorted(by_line.items())))
    assert [r["text"] for r in got] == exp
    assert all(r["n_tokens"] <= size for r in got)

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from colloquy.llm import textbytes as tb

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.fixture(params=[64, 1 << 21])
def block(request, monkeypatch):
    monkeypatch.setattr(tb, "BLOCK_BYTES", request.param)


def texts():
    rng = random.Random(2)
    parts = ["a", "B", "é", "中", "😀", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "word", "x" * 90]
    return ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(300)] + [None, "", " ", "y" * 500, "end"]


def test_words_and_shingles_equal_the_pattern(block):
    rows = texts()
    hashes, offsets = tb.word_hashes(pa.array(rows))
    want = [words(t) for t in rows]
    assert np.diff(offsets).tolist() == [len(w) for w in want]
    seen = {}
    for word, h in zip((w for ws in want for w in ws), hashes.tolist()):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    for size in (1, 3, 5):
        sh, edges = tb.shingle_hashes(hashes, offsets, size)
        named = {}
        for i, ws in enumerate(want):
            own = [tuple(ws[j:j + size]) for j in range(len(ws) - size + 1)] if len(ws) >= size else [tuple(ws)] if ws else []
            assert len(own) == edges[i + 1] - edges[i]
            for s, h in zip(own, sh[edges[i]:edges[i + 1]].tolist()):
                assert named.setdefault(s, h) == h
        assert len(set(named.values())) == len(named)


def test_sliced_and_empty_columns():
    rows = texts()
    whole, sliced = pa.array(rows), pa.array(["junk", None, *rows]).slice(2)
    for a, b in zip(tb.word_hashes(whole), tb.word_hashes(sliced)):
        assert (a == b).all()
    hashes, offsets = tb.word_hashes(pa.array([], pa.string()))
    assert len(hashes) == 0 and offsets.tolist() == [0]
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 50, None, "b" * 200, "c"])], ["text"])
    assert [p.num_rows for p in tb.slices(batch, "text", 100)] == [2, 1, 1]

import hashlib
import random
import re
import time

import pytest

from colloquy.llm import pii
from tests.llm.conftest import SF

#: The base patterns as they are stated.
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")) or k == 2 and not (
                    14 <= len(d) <= 19 and pii.luhn(d)) or k == 3 and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_query_has_the_base_spans_of_the_whole_table(spark, queries):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries["op2_pii"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r["doc_id"]])
        assert tuple(r[1:5]) == tuple(sum(s[1] == k for s in want) for k in range(4))
        assert r["base_sha256"] == hashlib.sha256(pii.render(want).encode()).hexdigest()
        assert set(pii.render(want).split(",")) - {""} <= set(r["spans"].split(","))


def test_base_spans_equal_the_patterns_on_odd_strings():
    rng = random.Random(1)
    parts = list("0123456789") * 3 + list("@@..--++ ()ab_%") + ["1.2.3.4", "a@b.c", "4111111111111111",
                                                                "+1 (183) 555-1276", "255", "é"]
    for _ in range(20_000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        assert pii.base_spans(t) == plain(t), t


def test_long_runs_take_linear_time():
    for run in ("1" * 200_000, "a." * 100_000, "a@" * 100_000, "+1(" * 60_000, "1 " * 100_000, "1." * 100_000):
        pii.base_spans(run)


def test_field_adds_other_forms_and_leaves_clean_text_alone(model):
    found = lambda t: [(pii.KINDS[k], t[a:b]) for a, k, b in pii.all_spans(t, model)[1]]
    assert found("tel 212-555-0187.") == [("phone", "212-555-0187")]
    assert found("call (212) 555-0187 now") == [("phone", "(212) 555-0187")]
    assert found("card 4111.1111.1111.1111 ok") == [("card", "4111.1111.1111.1111")]
    for clean in ("in 2024-01-02 12:30", "number 12345678901 x", "1,234,567,890", "2021 2022 2023", "v1.2.33", "x @12",
                  "no digits at all", "4111/1111/1111/1112", "10.300.2.1", "a1b2c3"):
        assert found(clean) == [], clean


def test_the_program_is_exact(model):
    """The best segmentation of random islands equals a search of them all."""
    rng = random.Random(4)
    parts = ["212-555-0187", "4111.1111.1111.1111", "12", "(212)", "555-0187", "1.2.3.4", "a@b", "9807915762804490"]
    for _ in range(30):
        text = " ".join(rng.choices(parts, k=rng.randint(1, 5)))
        tokens = pii.islands(text, [])[0]
        graph = pii.lattice(text, tokens)

        def best(j):
            if j == 0:
                return 0.0
            return max([best(j - 1)] + [best(i) + model.score(k, f) - pii.MARGIN for i, k, _, _, f in graph[j - 1]])
        ends = {(a, k, b): f for here in graph for _, k, a, b, f in here}
        got = model.best(text, tokens)
        assert abs(sum(model.score(s[1], ends[s]) - pii.MARGIN for s in got) - best(len(tokens))) < 1e-9


def test_masking_keeps_columns_and_edge_rows(docs_of, model):
    rows = [(1, "mail me@x.org or +1 (183) 555-1276!"), (2, None), (3, ""), (None, "1.2.3.4 é"), (4, "clean"), (4, "clean"),
            (5, "pad " * 20_000 + "me@x.org")]
    docs = docs_of(rows)
    out = pii.masked(docs, model)
    assert out.schema.simpleString() == docs.schema.simpleString()
    got = [(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()]
    want = [(1, "mail [EMAIL] or [PHONE]!"), (2, None), (3, ""), (None, "[IP] é"), (4, "clean"), (4, "clean"),
            (5, "pad " * 20_000 + "[EMAIL]")]
    assert sorted(got, key=str) == sorted([(i, t, None if t is None else len(t)) for i, t in want], key=str)
    assert pii.find(docs_of([])).count() == 0 and pii.masked(docs_of([])).count() == 0
    assert [r["spans"] for r in pii.find(docs_of(["nothing", None])).collect()] == ["", ""]


def test_rare_kinds_beside_a_hot_source_are_learned(docs_of):
    """Version strings in nearly all texts, one kind only in a long text, cards only in groups."""
    rows = [f"release {i}.{i % 7}.{i % 11} is out" for i in range(2000)] + [f"write to me{i}@host.org soon" for i in range(200)]
    rows += ["pad " * 10_000 + "call +1 (183) 555-1276 today", "pay by card 4111 1111 1111 1111 please"]
    found = pii.examples(docs_of(rows))
    assert {k for k, *_ in found} == {0, 2, 3}
    assert {s for k, _, s, _ in found if k > 1} == {"4111 1111 1111 1111", "+1 (183) 555-1276"}
    model = pii.fit(docs_of(rows))
    assert {2, 3} <= {k for k, _ in model.index}
    got = {pii.KINDS[k] for t in ("call (212) 555-0187 today", "pay by card 4111.1111.1111.1111 please")
           for _, k, _ in pii.all_spans(t, model)[1]}
    assert got == {"phone", "card"}


def test_the_sample_has_a_bound_for_each_kind(docs_of):
    rows = [f"mail user{i}@host.org and 10.0.{i % 250}.{i // 250} end" for i in range(2000)] * 2
    found = pii.examples(docs_of(rows))
    assert all(0 < sum(k == kind for k, *_ in found) <= pii.SAMPLE for kind in (0, 1))
    assert sorted(found) == sorted(pii.examples(docs_of(rows[::-1]).repartition(7)))


def test_linear_time_on_long_runs_and_equal_tokens():
    text = "a1 b\tc@d  (9) 12-3x\n\u00e97\x1c8 @ z"
    assert [text[a:b] for a, b in pii.tokens_of(text)] == re.findall(r"[^\s]*[0-9@][^\s]*", text)
    model = pii.Field()
    began = time.monotonic()
    for piece in ("x", "(", "1", "1.", "-", "a@", "+1", "\u4e00", "((1"):
        pii.all_spans(piece * (1_000_000 // len(piece)) + "7", model)
    assert time.monotonic() - began < 60

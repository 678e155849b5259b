"""License scans: base places against a brute force over words, fuzzy matches
against the edit distances of all substrings."""

import random
import re
import time

from colloquy.llm import licences

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    hits = [(i, label) for p, label in PHRASES.items() for i in range(len(words))
            if words[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return (len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits})))


def distance(text, notice):
    """The least edits from ``notice`` to any substring of ``text`` (Sellers)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(notice):
        after = [i + 1]
        for j, d in enumerate(text):
            after.append(min(row[j] + (c != d), row[j + 1] + 1, after[j] + 1))
        row = after
    return min(row)


def damaged(rnd, notice, n):
    for _ in range(n):
        i = rnd.randrange(len(notice))
        notice = rnd.choice([notice[:i] + rnd.choice("xyz ") + notice[i:], notice[:i] + notice[i + 1:],
                             notice[:i] + rnd.choice("qjx") + notice[i + 1:]])
    return notice


def test_base_equals_brute_force(spark):
    rnd = random.Random(1)
    parts = ["GNU", "General", "public", "License", "Apache", "license", "CC", "BY", "cc-by", "MIT", "mit license", "é", "ÉMIT",
             "\n", "1", "a_b", "mit\x85license", "cc by", "MIT LICENSE", "gnu general public license", "퟿", ""]
    texts = [None, "", " ", "cc by cc by cc by", "xcc by", "cc byx", "CC.BY", "cc\x00by"]
    texts += [rnd.choice([" ", "-", ". "]).join(rnd.choices(parts, k=rnd.randint(1, 40))) for _ in range(300)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, "MIT license", "en", "s", 0), (3, "cc by", "en", "s", 0)]
    got = licences.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == \
        sorted(((d, *base(t)) for d, t, *_ in rows), key=str)
    for r in got:
        told = set(r.labels.split(",")) - {""}
        assert set(r.base_labels.split(",")) - {""} <= told and 0 <= r.score <= 1 and (r.score > 0) == bool(told)


def test_notices_are_found_exactly_where_the_edits_allow():
    rnd = random.Random(2)
    names = tuple(n for n, _ in licences.NOTICES)
    for _ in range(150):
        n = rnd.choice(names)
        text = " ".join(["foo the under", damaged(rnd, n, rnd.randint(0, licences.edits(n) + 2)), "of license bar", rnd.choice(names)[:20]])
        found = licences.fuzzy(text, names)
        for i, notice in enumerate(names):
            k = licences.edits(notice)
            here = [m for m in found if m[2] == i]
            assert bool(here) == (distance(text, notice) <= k), (text, notice)
            for a, b, _, e in here:
                assert e <= k and distance(text[a:b], notice) <= e


def test_cutting_long_windows_loses_nothing():
    rnd = random.Random(4)
    for notice, _ in licences.NOTICES:
        noise = lambda: " ".join(rnd.choices(notice.split(), k=60))
        stretch = noise() + " " + damaged(rnd, notice, licences.edits(notice)) + " " + noise()
        kept = licences.likely(stretch, notice)
        best = distance(stretch, notice)
        assert min(distance(stretch[a:b], notice) for a, b in kept) == best


def test_spans_and_overlaps():
    text = "é — Releasd under the MIT-Licence.  Licensed under CC BY-NC 4.0! GNU\nGeneral Public License"
    *_, labels, score, spans = licences.scan_text(text)
    assert labels == "cc-by,gpl,notice-cc-by-nc,notice-mit" and score == 1.0
    held = {tuple(s.split(":")) for s in spans.split(",")}
    cut = {(label, text[int(a):int(b)], int(e)) for label, a, b, e in held}
    assert cut == {("notice-mit", "Releasd under the MIT-Licence", 2), ("notice-cc-by-nc", "Licensed under CC BY-NC 4.0", 0),
                   ("cc-by", "CC BY", 0), ("gpl", "GNU\nGeneral Public License", 0)}


def test_long_texts_take_linear_time():
    for piece in ("license ", "released under the ", "a", "licensed under cc by cc by ", "free of charge to any persn "):
        before = time.time()
        licences.scan_text(piece * (400_000 // len(piece)))
        assert time.time() - before < 20, piece


def test_empty_table_and_extra_columns(spark):
    assert licences.scan(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = spark.createDataFrame([("x", 1, "MIT license", 2.0)], "labels string, doc_id int, text string, score double")
    assert licences.scan(rows).collect()[0].base_labels == "mit"

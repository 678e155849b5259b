"""License scans: fuzzy search for short notices.

A text is read as its words (A-Z lower-cased), joined by single spaces. Two
kinds of evidence are reported. *Base* places: a license's name, word for
word. *Notices*: short license notices with a bounded number of edits, found
by the pigeonhole principle: a notice cut into one seed more than it may have
edits holds at least one seed unchanged, so a search for all seeds of all
notices at once (Aho-Corasick) loses nothing. Around the seeds, windows as
long as a match can reach are cut at word ends, and the regex library's
bounded-error matching verifies them and gives span and edits. A long window
is first cut to where enough of the notice's character pairs stand together.
Of matches that overlap, the one with fewer edits for its length stays.

All rows are scanned by a map over them; nothing is shuffled.
"""

from __future__ import annotations

import re
from functools import cache
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import textbytes

#: Names of licenses, word for word, and their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
#: Notices of licenses as they are usually written, as words, and their labels.
NOTICES = [
    ("released under the mit license", "notice-mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "notice-mit"),
    ("licensed under the apache license version 2 0", "notice-apache"),
    ("licensed under the gnu general public license version", "notice-gpl"),
    ("gnu lesser general public license", "notice-lgpl"),
    ("gnu affero general public license", "notice-agpl"),
    ("licensed under cc by 4 0", "notice-cc-by"),
    ("licensed under cc by sa 4 0", "notice-cc-by-sa"),
    ("licensed under cc by nc 4 0", "notice-cc-by-nc"),
    ("creative commons attribution sharealike", "notice-cc-by-sa"),
    ("creative commons attribution noncommercial", "notice-cc-by-nc"),
    ("creative commons attribution 4 0 international", "notice-cc-by"),
    ("redistribution and use in source and binary forms", "notice-bsd"),
    ("mozilla public license version 2 0", "notice-mpl"),
    ("eclipse public license version", "notice-epl"),
    ("permission to use copy modify and or distribute this software", "notice-isc"),
    ("this is free and unencumbered software released into the public domain", "notice-unlicense"),
    ("all rights reserved", "notice-all-rights-reserved"),
]
#: A notice may have one edit for every so many of its characters.
PER_EDIT = 10

SEPARATED = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_FOLD = bytes(32 if b < 128 and not chr(b).isalnum() else b + 32 if 65 <= b <= 90 else b for b in range(256))
OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
       "score double, spans string")


def edits(notice: str) -> int:
    """The most edits (insertions, deletions, substitutions) of a notice."""
    return max(1, len(notice) // PER_EDIT)


def seeds(notice: str) -> list[tuple[int, str]]:
    """(start, seed): the notice cut into edits + 1 pieces of about one length."""
    n = edits(notice) + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@cache
def searcher(notices: tuple[str, ...]):
    """(automaton of all seeds, a pattern for each notice)."""
    found: dict[str, list[tuple[int, int]]] = {}
    for i, notice in enumerate(notices):
        for start, seed in seeds(notice):
            found.setdefault(seed, []).append((i, start))
    automaton = ahocorasick.Automaton()
    for seed, where in found.items():
        automaton.add_word(seed, (len(seed), tuple(where)))
    automaton.make_automaton()
    return automaton, [regex.compile(rf"(?e)(?:{regex.escape(n)}){{e<={edits(n)}}}") for n in notices]


def windows(text: str, notices: tuple[str, ...]) -> dict[int, list[tuple[int, int]]]:
    """For each notice, the stretches of ``text`` that a match can lie in:
    around every seed, joined where they overlap."""
    automaton, _ = searcher(notices)
    out: dict[int, list[tuple[int, int]]] = {}
    for last, (size, where) in automaton.iter(text):
        for i, start in where:
            k, at = edits(notices[i]), last + 1 - size
            a, b = max(0, at - start - k), min(len(text), at - start + len(notices[i]) + k)
            held = out.setdefault(i, [])
            if held and a <= held[-1][1]:
                held[-1] = (min(a, held[-1][0]), max(b, held[-1][1]))
            else:
                held.append((a, b))
    return out


def likely(stretch: str, notice: str) -> list[tuple[int, int]]:
    """The parts of ``stretch`` that can hold the notice: an edit destroys two
    of its pairs of characters at most, so a match leaves all but 2 * edits of
    them in as many characters as it can take. Nothing is lost."""
    k = edits(notice)
    width = len(notice) + k
    if len(stretch) <= 2 * width:
        return [(0, len(stretch))]
    pairs = lambda t: (lambda c: (c[:-1] << np.uint64(32)) | c[1:])(
        np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64))
    held, lacking = pairs(stretch), np.zeros(len(stretch), np.int32)
    until = np.minimum(np.arange(len(stretch)) + width - 1, len(held))
    start = np.minimum(np.arange(len(stretch)), len(held))
    for pair, wanted in zip(*np.unique(pairs(notice), return_counts=True)):
        before = np.concatenate([[0], np.cumsum(held == pair, dtype=np.int32)])
        lacking += np.maximum(wanted.astype(np.int32) - (before[until] - before[start]), 0)
    at = np.flatnonzero(lacking <= 2 * k)
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > width) + 1
    firsts, lasts = at[np.concatenate([[0], breaks])], at[np.concatenate([breaks - 1, [len(at) - 1]])]
    return [(int(x), min(int(y) + width, len(stretch))) for x, y in zip(firsts, lasts)]


def fuzzy(text: str, notices: tuple[str, ...]) -> list[tuple[int, int, int, int]]:
    """(start, end, notice, edits) of the matches in ``text``, leftmost and not
    overlapping for each notice."""
    _, patterns = searcher(notices)
    found = []
    for i, held in windows(text, notices).items():
        for a, b in held:
            for x, y in likely(text[a:b], notices[i]):
                found += [(m.start(), m.end(), i, sum(m.fuzzy_counts)) for m in patterns[i].finditer(text, a + x, a + y)]
    return sorted(found)


def best(found: list, notices: tuple[str, ...]) -> list:
    """Without a match that overlaps one with fewer edits for its length."""
    share = lambda m: m[3] / len(notices[m[2]])
    kept = []
    for m in found:
        while kept and m[0] < kept[-1][1] and share(m) < share(kept[-1]):
            kept.pop()
        if not (kept and m[0] < kept[-1][1] and share(kept[-1]) < share(m)):
            kept.append(m)
    return kept


def places(norm: bytes, phrase: str) -> list[int]:
    """Where a phrase's words stand in ``norm`` (words with a space before and
    after each): the byte of the space before them."""
    needle, out = b" " + phrase.encode() + b" ", []
    at = norm.find(needle)
    while at >= 0:
        out.append(at)
        at = norm.find(needle, at + 1)
    return out


def scan_text(text: str, notices: tuple[tuple[str, str], ...] = tuple(NOTICES)) -> tuple:
    """The columns after doc_id for one text."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    norm = b" " + b" ".join(words) + b" "
    base = sorted((at, label, len(phrase.split())) for phrase, label in BASE for at in places(norm, phrase))
    read, told = norm[1:-1].decode("utf-8", "surrogatepass"), tuple(n for n, _ in notices)
    close = best(fuzzy(read, told), told)
    if not base and not close:
        return len(words), 0, None, None, "", "", 0.0, ""
    starts, done, word = [], 0, 0
    for at, _, _ in base:
        word += norm.count(b" ", done, at)
        starts.append(word)
        done = at
    ends = [m.span() for m in SEPARATED.finditer(text.translate(_LOWER))]
    spans = [(ends[w][0], ends[w + n - 1][1], label, 0) for w, (_, label, n) in zip(starts, base)]
    spans += _in_text(read, close, ends, notices)
    spans.sort()
    labels = {label for _, label, _ in base}
    score = max([1.0] * bool(base) + [1.0 - e / len(notices[i][0]) for _, _, i, e in close])
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {notices[i][1] for _, _, i, _ in close})), score,
            ",".join(f"{label}:{a}:{b}:{e}" for a, b, label, e in spans))


_LOWER = {c: c + 32 for c in range(65, 91)}


def _in_text(read: str, close: list, ends: list[tuple[int, int]], notices) -> list[tuple]:
    """The matches as (start, end, label, edits) in code points of the text,
    widened to whole words."""
    out, at, word = [], 0, 0
    for a, group in groupby(close, key=lambda m: m[0]):
        word += read.count(" ", at, a)
        at = a
        for _, b, i, e in group:
            last = word + read.count(" ", a, max(a, b - 1))
            out.append((ends[word + (read[a:a + 1] == " ")][0], ends[last][1], notices[i][1], e))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_base (base
    places), first_word and last_word (smallest and largest word, from 0, that
    a base place starts at; null without one), base_labels, labels (those of
    the notices too), score (1 for a base place, else the share of the best
    notice's characters that is not edited; 0 without one), spans
    (label:start:end:edits of all places, in code points of the text, by start).

    A null text is empty: no words, no labels, score 0. Repeated rows and null
    ids are rows like any other. Very long texts are read whole, in time linear
    in their length. Other columns are not read; an empty table gives no rows."""

    def run(batches):
        for batch in batches:
            for part in textbytes.slices(batch, "text"):
                rows = [scan_text(t or "") for t in part.column(1).to_pylist()]
                columns = list(zip(*rows)) or [[]] * 8
                types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                    [c.split()[0] for c in OUT.split(", ")])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, OUT)

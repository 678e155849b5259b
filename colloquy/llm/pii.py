"""Personal data: base patterns, and a semi-Markov conditional random field.

The base patterns (email, ip, card, phone) are matched as stated, each in one
linear pass, and always stay. A semi-Markov CRF then looks for what they do
not match, such as numbers without a plus sign or with other separators: it
scores whole candidate segments by features of the span (digits, shape,
separators, check digit, neighbours), and a dynamic program over segments of
bounded length chooses boundaries and types jointly.

An entity holds a digit or an at sign in every token, so the text falls apart
into islands of such tokens; between islands nothing but "outside" is
possible, and the best labelling of a text is that of its islands. Tokens
that a base span touches are not relabelled.

The field is trained in numpy on a bounded sample of the base spans of each
kind with what stands around them, and on variants of them without what makes
the base patterns match. The spans are looked for in the whole of every text,
so a kind that occurs anywhere in the table is learned; a task sends at most
the sample. Every row is scored in its task; no text is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes

KINDS = ["email", "ip", "card", "phone"]
#: Most tokens of an entity; most characters of one; base spans of each kind that the field is fitted on.
LONGEST, CHARS, SAMPLE = 8, 254, 128
#: Characters before and after a base span that the field is fitted on with it.
CONTEXT = 40
#: An entity must beat "outside" by this much (log-odds) to be added.
MARGIN = 2.0

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]\S*+")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, leftmost and
    non-overlapping for each kind, failing matches dropped; sorted."""
    out = []
    last = 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            at = m.start()
            while at > last and text[at - 1] in _LOCAL:
                at -= 1
            if at < m.start():
                out.append((at, 0, m.end()))
                last = m.end()
    # a run of digits that is not followed by the next part fails at each of its starts, so one is tried
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m.group()) if m.end() - m.start() < 40 else ""
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# ---- whole-span features -------------------------------------------------

_TRIM = "\"'`.,;:!?<>[]{}|*%$&#"


def segment_span(text: str, start: int, end: int) -> tuple[int, int]:
    """The span of a segment without punctuation around it."""
    closes = text.rfind(")", start, end)
    while start < end and (text[start] in _TRIM or text[start] == ")" or (text[start] == "(" and closes < start)):
        start += 1
    opens = text.find("(", start, end)
    while end > start and (text[end - 1] in _TRIM or text[end - 1] in "-(" or (
            text[end - 1] == ")" and not 0 <= opens < end)):
        end -= 1
    return start, end


def shape(span: str) -> str:
    return re.sub(r"9{5,}", "9+", re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", span)))[:24]


def possible(span: str) -> list[int]:
    """Kinds that a span can be at all; a segment of no kind is not scored."""
    n = len(_DIGIT.findall(span))
    out = []
    if "@" in span and " " not in span and len(span) <= CHARS:
        out.append(0)
    if not re.search(r"[^\W\d_]|@", span):
        if n <= 12 and len(re.findall(r"[0-9]+", span)) == 4:
            out.append(1)
        if 13 <= n <= 19:
            out.append(2)
        if 9 <= n <= 15:
            out.append(3)
    return out


def features(text: str, start: int, end: int) -> list[str]:
    span = text[start:end]
    d = _digits(span)
    groups = re.findall(r"[0-9]+", span)
    seps = "".join(sorted(set(re.sub(r"[0-9A-Za-z]", "", span))))
    before = re.findall(r"[^\W\d_]+", text[max(0, start - 24):start].lower())
    out = ["bias", f"n={len(d)}", f"shape={shape(span)}", f"groups={'-'.join(str(len(g)) for g in groups[:6])}",
           f"count={min(len(groups), 7)}", f"seps={seps[:8]}", f"tokens={min(span.count(' ') + 1, 8)}",
           f"before={before[-1][:12] if before else ''}"]
    if 13 <= len(d) <= 19:
        out.append(f"luhn={luhn(d)}")
    if len(groups) == 4:
        out.append(f"octets={all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    if "@" in span:
        left, _, right = span.partition("@")
        out.append(f"mail={bool(left)}{'.' in right.strip('.')}{'@' in right}")
    return out


def tokens_of(text: str) -> Iterator[tuple[int, int]]:
    """The words between white space that have a digit or an at sign, in time
    linear in the text: first such a sign is found, then the word around it."""
    last = 0
    for m in _MARK.finditer(text):
        at = m.start()
        while at > last and not text[at - 1].isspace():
            at -= 1
        yield at, m.end()
        last = m.end()


def islands(text: str, spans: list[tuple[int, int, int]]) -> list[list[tuple[int, int]]]:
    """Runs of tokens with a digit or an at sign, one space apart and untouched
    by ``spans``. An entity broken by other or more white space is not a segment."""
    out: list[list[tuple[int, int]]] = []
    k, ends = 0, -1
    for start, end in tokens_of(text):
        while k < len(spans) and spans[k][0] < end:
            ends = max(ends, spans[k][2])
            k += 1
        if ends > start:
            continue
        if out and start - out[-1][-1][1] == 1 and text[start - 1] == " ":
            out[-1].append((start, end))
        else:
            out.append([(start, end)])
    return out


def lattice(text: str, tokens: list[tuple[int, int]]) -> list[list[tuple[int, int, int, int, list[str]]]]:
    """For each token, the entity segments that end with it: (first token,
    kind, span start, span end, features)."""
    out = []
    for j in range(len(tokens)):
        here = []
        for i in range(j, max(-1, j - LONGEST), -1):
            a, b = segment_span(text, tokens[i][0], tokens[j][1])
            if a >= b or b - a > CHARS:
                continue
            if a >= tokens[i][1] or b <= tokens[j][0]:
                continue  # its first or last token is punctuation only
            kinds = possible(text[a:b])
            if kinds:
                f = features(text, a, b)
                here += [(i, k, a, b, f) for k in kinds]
        out.append(here)
    return out


# ---- the field ----------------------------------------------------------

@dataclass
class Field:
    """Weights of (kind, feature); "outside" has weight 0."""
    index: dict[tuple[int, str], int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def score(self, kind: int, names: list[str]) -> float:
        w = self.weights
        return sum(w[k] for k in (self.index.get((kind, n)) for n in names) if k is not None)

    def best(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """The best segmentation of an island: (start, kind, end) of its entities."""
        top, back = [0.0], []
        for j, segments in enumerate(lattice(text, tokens)):
            value, choice = top[j], None
            for i, k, a, b, names in segments:
                v = top[i] + self.score(k, names) - MARGIN
                if v > value:
                    value, choice = v, (i, (a, k, b))
            top.append(value)
            back.append(choice)
        out, j = [], len(tokens)
        while j:
            choice = back[j - 1]
            if choice is None:
                j -= 1
            else:
                j = choice[0]
                out.append(choice[1])
        return out[::-1]


def train(examples: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 15, rate: float = 0.5,
          decay: float = 1e-3) -> Field:
    """Fit by gradient ascent on the likelihood of whole segmentations: forward
    and backward sums over the segments of every island. ``examples``: text and
    its spans (start, kind, end)."""
    out, graphs = Field(), []
    for text, spans in examples:
        gold = {(a, k, b) for a, k, b in spans}
        for tokens in islands(text, []):
            edges = [(i, j, (a, k, b) in gold, [out.index.setdefault((k, n), len(out.index)) for n in names])
                     for j, here in enumerate(lattice(text, tokens)) for i, k, a, b, names in here]
            if edges:
                graphs.append((len(tokens), edges))
    w = out.weights = np.zeros(len(out.index))
    seen = np.full(len(w), 1e-6)
    for _ in range(rounds):
        for n, edges in graphs:
            s = [w[e[3]].sum() for e in edges]
            forward = np.full(n + 1, -np.inf)
            forward[0] = 0.0
            at = 0
            for j in range(n):
                forward[j + 1] = forward[j]
                while at < len(edges) and edges[at][1] == j:
                    forward[j + 1] = np.logaddexp(forward[j + 1], forward[edges[at][0]] + s[at])
                    at += 1
            backward = np.full(n + 1, -np.inf)
            backward[n] = 0.0
            at = len(edges) - 1
            for j in range(n - 1, -1, -1):
                backward[j] = np.logaddexp(backward[j], backward[j + 1])
                while at >= 0 and edges[at][1] == j:
                    i = edges[at][0]
                    backward[i] = np.logaddexp(backward[i], s[at] + backward[j + 1])
                    at -= 1
            for e, v in zip(edges, s):
                p = np.exp(min(0.0, forward[e[0]] + v + backward[e[1] + 1] - forward[n]))
                g = (float(e[2]) - p) - decay * w[e[3]]
                seen[e[3]] += g * g
                w[e[3]] += rate * g / np.sqrt(seen[e[3]])
    return out


def variants(text: str, spans: list[tuple[int, int, int]], rng: Random):
    """The text's entities rewritten in forms that the base patterns miss, each
    in its surroundings, and look-alikes that are nothing."""
    for a, k, b in spans:
        left, right, span = text[max(0, a - CONTEXT):a], text[b:b + CONTEXT], text[a:b]
        d = _digits(span)
        forms = [span]
        if k == 3:
            t = d[-10:]
            forms += [f"({t[:3]}) {t[3:6]}-{t[6:]}", f"{t[:3]}-{t[3:6]}-{t[6:]}", f"{t[:3]}.{t[3:6]}.{t[6:]}",
                      f"1-{t[:3]}-{t[3:6]}-{t[6:]}", f"00{d[:-10] or '1'} {t[:3]} {t[3:6]} {t[6:]}"]
        elif k == 2 and len(d) == 16:
            forms += [c.join(d[i:i + 4] for i in range(0, 16, 4)) for c in "./"]
        elif k == 0:
            forms += [span.replace(".", "_", 1) if span.index(".") < span.index("@") else "x_" + span]
        for f in forms:
            yield left + f + right, [(len(left), k, len(left) + len(f))]
        digit = lambda n: "".join(rng.choices("0123456789", k=n))
        year = f"{rng.randint(1900, 2030)}"
        bad = digit(15)
        bad += next(c for c in "0123456789" if not luhn(bad + c))
        for f in (digit(rng.randint(1, 12)), bad, f"{year}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}", digit(9), digit(10),
                  f"{year}-0{rng.randint(1, 9)}-{rng.randint(10, 28)} {rng.randint(10, 23)}:{rng.randint(10, 59)}",
                  f"{digit(3)}.{digit(3)}", f"{year} {year} {year}", f"{year}-{year}", f"v{digit(1)}.{digit(1)}.{digit(2)}",
                  f"978-{digit(1)}-{digit(4)}-{digit(4)}-{digit(1)}", f"{digit(3)} {digit(3)} {digit(3)} {digit(3)}",
                  f"4{digit(2)}.{digit(3)}.{digit(3)}.9{digit(2)}", f"\"{rng.getrandbits(160):040x}\"", "@" + digit(3),
                  f"{digit(4)} {digit(4)} {digit(4)}", f"{digit(2)},{digit(3)},{digit(3)},{digit(3)}", digit(13)):
            yield left + f + right, []


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def examples(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[int, str, str, str]]:
    """At most ``sample`` base spans of each kind in ``docs``: (kind number,
    text before it, span, text after it). The hash of a span gives its slot,
    one of ``sample`` for each kind, and each slot keeps the span of the lowest
    hash: a kind that occurs at all has one, and neither the number of times
    that a span is repeated nor other kinds or texts without spans matter."""

    def run(batches):
        kept = {}
        for batch in batches:
            for part in textbytes.slices(batch, "text"):
                for text in part.column(0).to_pylist():
                    for a, k, b in base_spans(text or ""):
                        if b - a > CHARS:
                            continue  # no segment is that long
                        span = text[a:b]
                        rank = _number(span)
                        at = k, rank % sample
                        if at in kept and kept[at][0] < rank:
                            continue
                        left, right = text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]
                        new = rank, _number(f"{left}\n{right}"), left, span, right
                        kept[at] = min(kept.get(at, new), new)
        rows = [(*at, *row) for at, row in kept.items()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.string()] * 3)],
                ["kind", "slot", "rank", "place", "left", "span", "right"])

    found = docs.select("text").mapInArrow(
        run, "kind int, slot int, rank long, place long, left string, span string, right string")
    best = found.groupBy("kind", "slot").agg(F.min(F.struct("rank", "place", "left", "span", "right")).alias("s"))
    return [(r["kind"], r["s"]["left"], r["s"]["span"], r["s"]["right"])
            for r in sorted(best.collect(), key=lambda r: (r["slot"], r["kind"]))]


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """The field of a table: trained on at most ``sample`` of its base spans of
    each kind. A kind without base spans has no weight, so that a table without
    base spans has a field that adds nothing."""
    rng, rows = Random(0), []
    for k, left, span, right in examples(docs, sample):
        rows += variants(left + span + right, [(len(left), k, len(left) + len(span))], rng)
    return train(rows)


def all_spans(text: str, model: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each sorted by start, then kind."""
    base = base_spans(text)
    if not _DIGIT.search(text) and "@" not in text:
        return base, base
    more = [s for tokens in islands(text, base) for s in model.best(text, tokens)]
    return base, sorted(base + more)


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span replaced by its kind, as ``[EMAIL]``; spans
    that overlap become one, of the kind that starts first."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _over(docs: DataFrame, schema: str, row, model: Field) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(model)
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string()}

    def run(batches):
        for batch in batches:
            for part in textbytes.slices(batch, "text"):
                rows = [row(t or "", *all_spans(t or "", model.value)) for t in part.column(1).to_pylist()]
                cols = [pa.array([r[i] for r in rows], types[c.split()[1]])
                        for i, c in enumerate(schema.split(", ")[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], names)

    return docs.mapInArrow(run, schema)


def find(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base
    spans), base_sha256 (of the base spans), spans (all spans, as
    ``kind:start:end`` in code points, comma-joined).

    Null and empty texts have no spans; repeated rows are repeated; long texts
    are searched whole; an empty table gives no rows. Only doc_id and text are
    read. ``model``: a field fitted before; else one is fitted on ``docs``."""

    def row(text, base, every):
        n = [sum(s[1] == k for s in base) for k in range(len(KINDS))]
        return (*n, hashlib.sha256(render(base).encode()).hexdigest(), render(every))

    schema = "doc_id long, " + "".join(f"n_{k} long, " for k in KINDS) + "base_sha256 string, spans string"
    return _over(docs.select("doc_id", "text"), schema, row, model or fit(docs))


def masked(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """``docs`` (columns of documents) with every span in its text replaced by
    its kind, and n_chars counted anew where the text changed. A null text stays
    null. Rows and other columns stay as they are."""
    fitted = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    at = docs.columns.index("text")
    named = docs.columns

    def run(batches):
        for batch in batches:
            for part in textbytes.slices(batch, "text"):
                texts = [None if t is None else mask(t, all_spans(t, fitted.value)[1])
                         for t in part.column(at).to_pylist()]
                columns = list(part.columns)
                columns[at] = pa.array(texts, part.column(at).type)
                yield pa.RecordBatch.from_arrays(columns, named)

    before = textbytes.unused(docs, "before")
    out = docs.withColumn(before, F.length("text"))
    named = out.columns
    schema = out.schema
    out = out.mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        changed = F.length("text") != F.col(before)
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)

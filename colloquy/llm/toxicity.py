"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its character n-grams, a window of
WINDOW words the mean of its words, and a linear softmax over that mean gives
the window's two class probabilities. Embeddings and softmax are trained
jointly in numpy. Misspellings that were never seen share most n-grams with a
word that was, and so its vector.

A text of many words is scored by its most toxic window, since a label marks a
whole text while a few words make it toxic: training starts with all windows of
a text under its label, and then keeps for toxic texts the windows that the
model itself ranks highest. A logistic fit on the training texts turns that
maximum, given the number of windows, into a probability.

The fit takes a bounded sample of labelled rows, of every length. Scoring is a map over all
rows: the softmax is linear, so a window's logit is the mean of its words'
logits, and each distinct word of a block of texts is looked at once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes

#: n-gram lengths, buckets they are hashed to, dimensions, words of a window.
GRAMS, BUCKETS, DIM, WINDOW = (3, 4, 5), 1 << 16, 8, 12
#: Labelled texts with label 0 and 1, and their bytes in all, that the fit aims at.
SAMPLE, SAMPLE_BYTES = (5000, 2500), (24 << 20, 12 << 20)
#: Texts that each label gives from each band of lengths (powers of two) at least, if it has them.
LEAST = 8
#: A longer text gives PASSAGES passages, spread evenly over it, of so many characters in all.
TEXT_BYTES, PASSAGES = 1 << 20, 16
#: Windows of a step.
BATCH = 256
#: Most windows that a text gives to one epoch.
PICKED = 10

#: White space is inside no word, so a line break separates words here. An end is stripped as the
#: beginning of the reversed text: a search for it from every character would take quadratic time.
_STRIP = re.compile(r"(?m)^(?:[^\w\n]|[\d_])+")


class Bags:
    """The n-gram buckets of a list of distinct words.

    A word is lower-cased and stripped of what is no letter at its ends, and
    stands between ``<`` and ``>``; its bag has its n-grams of each length and
    itself. A word without letters has an empty bag."""

    def __init__(self, words: list[str]):
        text = _STRIP.sub("", _STRIP.sub("", "\n".join(words).lower())[::-1])[::-1]
        points = np.frombuffer(("<" + text.replace("\n", ">\n<") + ">").encode("utf-32-le"), np.uint32)
        breaks = np.flatnonzero(points == 10)
        begin, end = np.append(0, breaks + 1), np.append(breaks, len(points))
        self.count = len(words)
        value = textbytes.mix(points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        line = np.repeat(np.arange(len(begin), dtype=np.int32), np.append(breaks + 1, len(points)) - begin)
        room = end[line] - np.arange(len(points))
        some = (end - begin > 2)[line]
        buckets, owners = [], []
        for n in GRAMS:
            total = np.zeros(len(points), np.uint64)
            for j in range(min(n, len(points))):
                total[:len(points) - j] += value[j:] * np.uint64(2 * (n * 8 + j) * 0x632BE59BD9B4E019 % (1 << 64) | 1)
            at = np.flatnonzero((room >= n) & some)
            buckets.append((textbytes.mix(total[at]) % np.uint64(BUCKETS)).astype(np.int32))
            owners.append(line[at])
        whole = np.zeros(len(begin), np.uint64)
        order = textbytes.mix(np.arange(1, 1 + (end - begin).max(), dtype=np.uint64)) | np.uint64(1)
        place = np.arange(len(points)) - begin[line]
        inside = place < (end - begin)[line]
        np.add.at(whole, line[inside], value[inside] * order[place[inside]])
        worded = np.flatnonzero(end - begin > 2)
        buckets.append((textbytes.mix(whole[worded]) % np.uint64(BUCKETS)).astype(np.int32))
        owners.append(worded.astype(np.int32))
        self.buckets = np.concatenate(buckets)
        self.owners = np.concatenate(owners)
        self.sizes = np.bincount(self.owners, minlength=self.count)[:self.count]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Mean over each word's bag of a value for each bucket; 0 for none."""
        total = np.bincount(self.owners, values[self.buckets], self.count)[:self.count]
        return total / np.maximum(self.sizes, 1)

    def sort(self) -> None:
        """Put the bags one after the other, for ``means`` and ``flatten``."""
        self.flat = self.buckets[np.argsort(self.owners, kind="stable")]
        self.buckets, self.owners = self.flat, np.repeat(np.arange(self.count, dtype=np.int32), self.sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def means(self, table: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Mean row of ``table`` over the bag of each word in ``index``."""
        flat, sizes = self.flatten(index)
        out = np.zeros((len(index), table.shape[1]))
        some = np.flatnonzero(sizes)
        if len(some):
            first = (np.cumsum(sizes) - sizes)[some]
            out[some] = np.add.reduceat(table[flat], first, axis=0) / sizes[some][:, None]
        return out

    def flatten(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[index]
        ends = np.cumsum(sizes)
        if not len(ends) or not ends[-1]:
            return self.flat[:0], sizes
        shift = np.repeat(self.starts[index] - (ends - sizes), sizes)
        return self.flat[np.arange(ends[-1]) + shift], sizes


def distinct_words(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, the word number at every position, row offsets)."""
    raw, offsets = textbytes.buffer_of(column)
    hashes, rows = textbytes.word_hashes(column)
    _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    starts, ends = textbytes._spans(raw[offsets[0]:offsets[-1]], offsets - offsets[0])
    view = raw[offsets[0]:offsets[-1]].tobytes()
    return [view[starts[i]:ends[i]].decode() for i in first], back, rows


def window_edges(n: int) -> np.ndarray:
    """Starts of the windows over ``n`` words: every half window; the last
    one ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.unique(np.append(np.arange(0, n - WINDOW, WINDOW // 2), n - WINDOW))


@dataclass
class Model:
    logits: np.ndarray  # of every bucket: its part in (toxic - other)
    bias: float
    scale: np.ndarray   # weights of the greatest window logit, of log(windows), and a constant

    def word_logits(self, words: list[str]) -> np.ndarray:
        return Bags(words).sums(self.logits) if words else np.zeros(0)

    def top_windows(self, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(greatest window logit, number of windows) of every row, given its
        words' logits."""
        sums = np.concatenate([[0.0], np.cumsum(values)])
        top = np.full(len(rows) - 1, self.bias)
        count = np.ones(len(rows) - 1)
        for r in range(len(rows) - 1):
            a, b = rows[r], rows[r + 1]
            if b > a:
                at = a + window_edges(b - a)
                end = np.minimum(at + WINDOW, b)
                top[r] = ((sums[end] - sums[at]) / (end - at)).max() + self.bias
                count[r] = len(at)
        return top, count

    def probability(self, top: np.ndarray, count: np.ndarray) -> np.ndarray:
        z = self.scale[0] * top + self.scale[1] * np.log(count) + self.scale[2]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))

    def score(self, column: pa.Array) -> np.ndarray:
        words, at, rows = distinct_words(column)
        return self.probability(*self.top_windows(self.word_logits(words)[at], rows))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 25) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; x has its constant."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w)
    return w


def train(texts: list[str], labels: np.ndarray, weights: np.ndarray, epochs: int = 3, rate: float = 0.3,
          seed: int = 1) -> Model:
    """Fit on texts with labels 0 or 1; ``weights`` undo the sampling of classes and lengths."""
    rng = np.random.default_rng(seed)
    words, at, rows = distinct_words(pa.array(texts, pa.large_string()))
    at = at.astype(np.int32)
    if not words:
        return Model(np.zeros(BUCKETS), 0.0, np.array([0.0, 0.0, -30.0]))
    bags = Bags(words)
    bags.sort()
    table = rng.uniform(-0.5, 0.5, (BUCKETS, DIM)) / DIM
    soft = rng.uniform(-0.5, 0.5, (DIM, 2))
    bias = np.zeros(2)
    seen_t, seen_s = np.full(BUCKETS, 1e-6), np.full((DIM, 2), 1e-6)
    edges = [rows[r] + window_edges(rows[r + 1] - rows[r]) for r in range(len(texts))]
    for epoch in range(epochs):
        logits = bags.sums(table @ (soft[:, 1] - soft[:, 0]))
        sums = np.concatenate([[0.0], np.cumsum(logits[at])])
        starts, ends, y = [], [], []
        for r, e in enumerate(edges):
            if rows[r + 1] == rows[r]:
                continue
            end = np.minimum(e + WINDOW, rows[r + 1])
            rank = np.argsort(-(sums[end] - sums[e]) / (end - e))
            if epoch and labels[r]:
                pick = rank[:2]
            elif epoch:
                pick = np.unique(np.concatenate([rank[:PICKED // 2], rng.permutation(len(e))[:PICKED // 2]]))
            else:
                pick = rng.permutation(len(e))[:PICKED]
            starts.append(e[pick])
            ends.append(end[pick])
            y.append(np.full(len(pick), labels[r]))
        starts, ends, y = (np.concatenate(v) for v in (starts, ends, y))
        order = rng.permutation(len(starts))
        for b in range(0, len(order), BATCH):
            some = order[b:b + BATCH]
            n = ends[some] - starts[some]
            place = np.arange(n.sum()) + np.repeat(starts[some] - (np.cumsum(n) - n), n)
            used, back = np.unique(at[place], return_inverse=True)
            vec = bags.means(table, used)
            first = np.cumsum(n) - n
            mean = np.add.reduceat(vec[back], first, axis=0) / n[:, None]
            z = mean @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            d = p.copy()
            d[np.arange(len(some)), y[some]] -= 1.0
            d /= len(some)
            g_soft, g_bias, g_mean = mean.T @ d, d.sum(0), d @ soft.T
            g_word = np.zeros((len(used), DIM))
            np.add.at(g_word, back, np.repeat(g_mean / n[:, None], n, axis=0))
            flat, sizes = bags.flatten(used)
            g_flat = np.repeat(g_word / np.maximum(sizes, 1)[:, None], sizes, axis=0)
            buckets, inv = np.unique(flat, return_inverse=True)
            g = np.zeros((len(buckets), DIM))
            np.add.at(g, inv, g_flat)
            seen_t[buckets] += (g * g).mean(1)
            table[buckets] -= rate * g / np.sqrt(seen_t[buckets])[:, None]
            seen_s += g_soft * g_soft
            soft -= rate * g_soft / np.sqrt(seen_s)
            bias -= 0.1 * g_bias
    model = Model(table @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]), np.array([1.0, 0.0, 0.0]))
    top, count = model.top_windows(model.word_logits(words)[at], rows)
    x = np.stack([top, np.log(count), np.ones(len(top))], 1)
    model.scale = logistic(x, labels.astype(float), weights)
    return model


def quotas(strata: dict[tuple[int, int], tuple[int, int]], sample: tuple[int, int],
           size: tuple[int, int]) -> dict[tuple[int, int], int]:
    """How many texts each (label, band) gives, from its (texts, bytes): the
    same share of every band of a label, so that ``sample`` rows and ``size``
    bytes hold the label, but LEAST texts of a band that has them."""
    out = {}
    for t in (0, 1):
        mine = {k: v for k, v in strata.items() if k[0] == t}
        n, total = (sum(v[i] for v in mine.values()) for i in (0, 1))
        share = min(1.0, sample[t] / max(n, 1), size[t] / max(total, 1))
        out |= {k: min(v[0], max(LEAST, round(share * v[0]))) for k, v in mine.items()}
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> Model | None:
    """A model from rows of ``labels`` (doc_id, toxic) with texts of ``docs``:
    of every length, chosen by a hash of the text within each label and band
    of lengths; see ``quotas`` for the bound. Of a text above TEXT_BYTES bytes
    PASSAGES passages are learned from. None if a class has no row."""
    marked = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    size = F.least(F.octet_length("text"), F.lit(TEXT_BYTES))
    sized = docs.select("doc_id", F.xxhash64("text").alias("key"), size.alias("size")).where("size > 0")
    # ids, hashes and lengths only: no text is shuffled before it is chosen
    texts = (sized.join(marked, "doc_id").withColumn("band", F.floor(F.log2("size")).cast("int"))
             .groupBy("toxic", "band", "key")
             .agg(F.min("doc_id").alias("doc_id"), F.max("size").alias("size"), F.count("*").alias("rows")))
    found = {(r["toxic"], r["band"]): r for r in texts.groupBy("toxic", "band").agg(
        F.count("*").alias("texts"), F.sum("size").alias("bytes"), F.sum("rows").alias("rows")).collect()}
    if len({t for t, _ in found}) < 2:
        return None
    wanted = quotas({k: (r["texts"], r["bytes"]) for k, r in found.items()}, sample, SAMPLE_BYTES)
    # hashes are even, so a bound on them leaves the wanted texts and a few more, which the task drops
    bound = F.lit(None).cast("long")
    for (t, band), q in wanted.items():
        share = (q + 6 * q ** 0.5 + 20) / found[t, band]["texts"]
        most = (1 << 63) - 1 if share >= 1 else int(share * (1 << 64)) - (1 << 63)
        bound = F.when((F.col("toxic") == t) & (F.col("band") == band), F.lit(most)).otherwise(bound)
    chosen = texts.where(F.col("key") <= bound).select("doc_id", "key", "toxic", "band")
    step = F.floor((F.length("text") - TEXT_BYTES // PASSAGES) / (PASSAGES - 1)).cast("int")
    passages = F.concat_ws("\n", *[F.substring("text", 1 + k * step, F.lit(TEXT_BYTES // PASSAGES))
                                   for k in range(PASSAGES)])
    # a text of few but wide characters is taken whole
    long = (F.octet_length("text") > TEXT_BYTES) & (F.length("text") > TEXT_BYTES)
    rows = (docs.select("doc_id", "text", F.xxhash64("text").alias("key")).join(F.broadcast(chosen), ["doc_id", "key"])
            .select("key", F.when(long, passages).otherwise(F.col("text")).alias("text"), "toxic", "band").distinct())

    def learn(batches):
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        left, kept = dict(wanted), []
        for r in rows:
            if left[r[2:]] > 0:
                left[r[2:]] -= 1
                kept.append(r)
        y = np.array([r[2] for r in kept], np.int64)
        weight = np.array([found[r[2:]]["rows"] / (wanted[r[2:]] - left[r[2:]]) for r in kept])
        m = train([r[1] for r in kept], y, weight / weight.mean())
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.logits.tobytes()]), pa.array([m.bias]), pa.array([m.scale.tolist()])],
            ["logits", "bias", "scale"])

    # the sample is bounded, so one task learns from it and sends the weights back
    out = rows.repartition(1).mapInArrow(learn, "logits binary, bias double, scale array<double>").collect()
    return Model(np.frombuffer(out[0]["logits"]), out[0]["bias"], np.array(out[0]["scale"])) if out else None


def is_held_out() -> F.Column:
    """Rows whose labels are never learned from: crc32 of the id's text, mod 5, is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def score(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted
    (1 if score >= 0.5).

    Only labels of rows that are not held out are learned from; the score sees
    nothing but the text. Null and empty texts, and texts without letters, get
    the score of a window without evidence; long texts are scored whole;
    repeated rows are repeated; without labels of both classes every score is
    0. An empty table gives no rows."""
    model = model or fit(docs, labels.where(~is_held_out()))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch in batches:
            for part in textbytes.slices(batch, "text"):
                s = np.zeros(part.num_rows) if m is None else m.score(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double").select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Quality classifier by co-training two views of a document.

*Text view*: what the words look like (how often they repeat nearby, symbols,
cell marks, capitals, lengths, lines). *Metadata view*: source, language and
stated length. Each view has its own logistic regression. Over the rounds each
scores all unlabelled documents and hands a bounded number that it is sure of
from every source and language, with its label, to the other view's training set. A view is sure where its own
calibration, fitted on labelled rows that neither view trains on, says so; a
view that knows little therefore teaches nothing.

At the end each view's score is calibrated on those rows, and the two log-odds
are added (the prior counted once). A document is kept if the sum favours it.

The fit takes a bounded sample of the labelled rows. The features of the
unlabelled ones are computed and written once; each round is a map over them.
All documents are scored by a map over them.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, discard, small_batches
from . import textbytes
from .toxicity import logistic

#: Most labelled rows of each class, and rounds of the fit.
LABELLED, ROUNDS = 3000, 4
#: How sure a view must be of a pseudo-label, the most of a class that it gives in a round, dealt
#: evenly to the pairs of source and language, and what each pair may give in any case.
SURE, GIVEN, EACH = 0.98, 500, 4
#: Words of a stretch in which repeated words are counted.
STRETCH = 64
TEXT = ["words", "repeated", "followed", "symbols", "symbol_words", "bars", "digits", "capitals", "foreign",
        "length", "short", "lines", "spaces"]
SLOTS = 64

_CLASS = np.full(256, 0, np.uint8)  # other bytes of ASCII are symbols
_CLASS[list(b" \t\n\r\x0b\x0c")] = 1
_CLASS[list(b"0123456789")] = 2
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 3
_CLASS[list(b"abcdefghijklmnopqrstuvwxyz")] = 4
_CLASS[128:] = 5
_MARKS = np.isin(np.arange(256), list(b".,;:!?'\"()-"))
_ODD = ((_CLASS == 0) & ~_MARKS).astype(np.uint8)


def _sums(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the bytes of ``flags`` from each start to the next one (starts ascend
    without repeats). The bytes are not widened, only the sums are."""
    return np.add.reduceat(flags, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)


def text_features(column: pa.Array) -> np.ndarray:
    """A row of TEXT features for every text. All are shares or logarithms, so
    they do not grow with the text; a text without words has zeros."""
    raw, offsets = textbytes.buffer_of(column)
    raw, offsets = raw[offsets[0]:offsets[-1]], offsets - offsets[0]
    hashes, rows = textbytes.word_hashes(column)
    n = len(offsets) - 1
    out = np.zeros((n, len(TEXT)))
    if not len(hashes):
        return out
    starts, ends = textbytes._spans(raw, offsets)
    owner = np.repeat(np.arange(n), np.diff(rows))
    per_row = lambda x: np.bincount(owner, x, n)
    words = np.maximum(np.diff(rows), 1)
    stretch = (np.arange(len(hashes)) - rows[owner]) // STRETCH
    key = textbytes.mix(hashes + textbytes.mix(owner.astype(np.uint64) * np.uint64(1 << 20) + stretch.astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    fresh = np.zeros(len(hashes))
    fresh[first] = 1.0
    follow = np.zeros(len(hashes))
    follow[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    kind, odd = _CLASS[raw], _ODD[raw]
    in_words = _sums(odd, starts)  # no separator is odd, so a word's bytes may go on to the next word
    sizes = np.diff(offsets)
    filled = np.flatnonzero(sizes)

    def count(flag):
        out = np.zeros(n)
        out[filled] = _sums(flag.view(np.uint8), offsets[filled])
        return out / np.maximum(sizes, 1)
    length = (ends - starts).astype(float)
    out[:, 0] = np.log1p(np.diff(rows))
    out[:, 1] = 1.0 - per_row(fresh) / words
    out[:, 2] = per_row(follow) / words
    out[:, 3] = count(odd)
    out[:, 4] = per_row(in_words >= 2) / words
    out[:, 5] = per_row((length == 1) & (raw[starts] == ord("|"))) / words
    out[:, 6] = count(kind == 2)
    out[:, 7] = count(kind == 3)
    out[:, 8] = count(kind == 5)
    out[:, 9] = np.log1p(per_row(np.minimum(length, 100)) / words)
    out[:, 10] = per_row(length <= 2) / words
    out[:, 11] = np.log1p(count(raw == 10) * 1000)
    out[:, 12] = count(kind == 1)
    out[np.diff(rows) == 0] = 0.0
    return out


def meta_features(source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Hashed slots of the whole source and language names, and the stated length."""
    out = np.zeros((len(source), SLOTS + 3))
    for salt, column in ((1, source), (2, lang)):
        coded = column.cast(pa.string()).dictionary_encode("encode")
        slot = [hashlib.blake2b(f"{salt}:{v}".encode(), digest_size=8).digest()[0] % SLOTS
                for v in coded.dictionary.to_pylist()]
        out[np.arange(len(column)), np.array(slot, int)[coded.indices.to_numpy()]] = 1.0
    stated = np.asarray(pc.fill_null(n_chars.cast(pa.float64()), math.nan))
    log = np.log1p(np.maximum(np.nan_to_num(stated), 0))
    out[:, SLOTS] = log
    out[:, SLOTS + 1] = (log - 7.0) ** 2
    out[:, SLOTS + 2] = np.isnan(stated)
    return out


@dataclass
class View:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> View:
        mean, spread = x.mean(0), x.std(0) + 1e-6
        view = View(mean, spread, np.zeros(x.shape[1] + 1))
        view.weights = logistic(view._design(x), y, weight, ridge=1.0)
        return view

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.spread, -6, 6), np.ones((len(x), 1))])

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        z = np.stack([self._design(x) @ self.weights, np.ones(len(x))], 1)
        a, b = logistic(z, y, weight, ridge=0.1)
        self.scale = (max(float(a), 0.0), float(b))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.scale[0] * (self._design(x) @ self.weights) + self.scale[1], -30, 30)


@dataclass
class Model:
    text: View
    meta: View
    prior: float  # log-odds of a good document

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of a good document: by the text, by the metadata, by both."""
        a, b = self.text.log_odds(text), self.meta.log_odds(meta)
        sigma = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        return sigma(a), sigma(b), sigma(a + b - self.prior)


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, weight: np.ndarray,
             pool_text: np.ndarray, pool_meta: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Two views from labelled rows (every third is kept for calibration) and a
    pool of unlabelled ones."""
    pools, bar = (pool_text, pool_meta), math.log(SURE / (1 - SURE))

    def draw(fitted, given):
        out = []
        for k in (0, 1):
            z = fitted[k].log_odds(pools[k]) if len(pool_text) else np.zeros(0)
            taken = np.isin(np.arange(len(z)), given[1 - k])
            rows = [(np.flatnonzero((sure >= bar) & ~taken), sure, label) for label, sure in ((1, z), (0, -z))]
            rows = [(free[np.argsort(-sure[free], kind="stable")[:GIVEN]], label) for free, sure, label in rows]
            at = np.concatenate([r for r, _ in rows])
            out.append((at, np.concatenate([np.full(len(r), label) for r, label in rows]), pools[1 - k][at]))
        return out

    return exchange(text, meta, y, weight, draw, rounds)


def exchange(text: np.ndarray, meta: np.ndarray, y: np.ndarray, weight: np.ndarray, draw, rounds: int = ROUNDS) -> Model:
    """Co-training. ``draw(views, given)`` is for each view what it hands over:
    (keys, labels, the other view's features) of unlabelled rows that it is
    sure of and whose keys are not among those ``given`` to the other view."""
    third = np.arange(len(y)) % 3 == 0
    if len(set(y[third].tolist())) < 2 or len(set(y[~third].tolist())) < 2:
        third = np.ones(len(y), bool)  # too few rows to keep some back
    learn = ~third if not third.all() else third
    views = text, meta
    given = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
    told = [(np.zeros(0, np.int64), v[:0]) for v in views]  # pseudo-labels that view k was given, and the rows
    for left in range(rounds, -1, -1):
        fitted = []
        for k in (0, 1):
            x = np.vstack([views[k][learn], told[k][1]])
            own = np.concatenate([y[learn], told[k][0]]).astype(float)
            w = np.concatenate([weight[learn], np.ones(len(told[k][0]))])
            view = View.fit(x, own, w)
            view.calibrate(views[k][third], y[third].astype(float), weight[third])
            fitted.append(view)
        if left:
            for k, (keys, label, x) in enumerate(draw(fitted, given)):
                given[1 - k] = np.concatenate([given[1 - k], keys])
                told[1 - k] = np.concatenate([told[1 - k][0], label]), np.vstack([told[1 - k][1], x])
    share = float((weight * y).sum() / weight.sum())
    return Model(fitted[0], fitted[1], math.log(share / (1 - share)))


META = ["source", "lang", "n_chars"]


def _featured(docs: DataFrame) -> DataFrame:
    """doc_id and the features of both views."""

    def run(batches):
        for batch in batches:
            for part in textbytes.slices(batch, "text", textbytes.BLOCK_BYTES):
                rows = [pa.array(list(x), pa.list_(pa.float64())) for x in (
                    text_features(part.column(1)), meta_features(*part.columns[2:5]))]
                yield pa.RecordBatch.from_arrays([part.column(0), *rows], ["doc_id", "x_text", "x_meta"])

    return _columns(docs).mapInArrow(run, "doc_id long, x_text array<double>, x_meta array<double>")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", *(F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c)
                                           for c in META))


def unlabelled(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(key, pair, x_text, source, lang, n_chars) of every row of ``docs`` with
    a text whose id is not in ``marked``, written. Rows of equal key are
    copies; ``pair`` is that of the slots of source and language."""

    def run(batches):
        for batch in batches:
            for part in textbytes.slices(batch, "text", textbytes.BLOCK_BYTES):
                x = text_features(part.column(1))
                slots = meta_features(*part.columns[2:5])[:, :SLOTS]
                pair = slots.argmax(1) * SLOTS + SLOTS - 1 - slots[:, ::-1].argmax(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(5), pa.array(pair.astype(np.int32)),
                     pa.array(list(x), pa.list_(pa.float64())), *part.columns[2:5]],
                    ["doc_id", "key", "pair", "x_text", *META])

    read = _columns(docs).where("text IS NOT NULL AND text != ''").withColumn("key", F.xxhash64("text", *META))
    kinds = ", ".join(f"{c} {read.schema[c].dataType.simpleString()}" for c in META)
    rows = lambda d: d.mapInArrow(run, f"doc_id long, key long, pair int, x_text array<double>, {kinds}")
    named = rows(read.where("doc_id IS NOT NULL")).join(marked, "doc_id", "left_anti")
    return cut_lineage(named.unionByName(rows(read.where("doc_id IS NULL"))).drop("doc_id"))


def sure_rows(pool: DataFrame, views: list[View], given: list[np.ndarray], each: int) -> list:
    """What each view hands over, as ``exchange`` wants it: of every pair of
    source and language at most ``each`` rows of each class. The key gives a
    row's slot, one of ``each``, and each slot hands over its surest row."""
    bar = math.log(SURE / (1 - SURE))
    held = pool.sparkSession.sparkContext.broadcast((views, given))

    def run(batches):
        views, given = held.value
        for batch in batches:
            key, pair = (batch.column(i).to_numpy() for i in (0, 1))
            text = batch.column(2).flatten().to_numpy().reshape(-1, len(TEXT))
            slot = (key.view(np.uint64) % np.uint64(each)).astype(np.int32)
            for k, x in enumerate((text, meta_features(*batch.columns[3:6]))):
                z = views[k].log_odds(x)
                new = ~np.isin(key, given[1 - k])
                for label, sure in ((1, z), (0, -z)):
                    at = np.flatnonzero((sure >= bar) & new)
                    at = at[np.lexsort((-key[at], -sure[at], slot[at], pair[at]))]
                    first = np.ones(len(at), bool)
                    first[1:] = (np.diff(pair[at]) != 0) | (np.diff(slot[at]) != 0)
                    at = at[first]
                    some = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), v, np.int32)) for v in (k, label)]
                        + [pa.array(slot[at]), pa.array(sure[at]), *some.columns],
                        ["view", "label", "slot", "sure", *batch.schema.names])

    kinds = ", ".join(f"{c} {pool.schema[c].dataType.simpleString()}" for c in pool.columns)
    best = (pool.mapInArrow(run, f"view int, label int, slot int, sure double, {kinds}")
            .groupBy("view", "label", "pair", "slot")
            .agg(F.max(F.struct("sure", "key", "x_text", *META)).alias("r")))
    rows = sorted(best.select("view", "label", "r.*").collect(), key=lambda r: (r["label"], r["key"]))
    held.unpersist()
    out = []
    for k in (0, 1):
        mine = [r for r in rows if r["view"] == k]
        x = (np.array([r["x_text"] for r in mine]).reshape(-1, len(TEXT)) if k else
             meta_features(*(pa.array([r[c] for r in mine]) if mine else pa.nulls(0, pa.string()) for c in META)))
        out.append((np.array([r["key"] for r in mine], np.int64), np.array([r["label"] for r in mine], np.int64), x))
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from rows of ``labels`` (doc_id, quality 0 or 1): at most LABELLED
    rows of each class, chosen by a hash of the id; and from all the rest of
    ``docs``. None if a class has no row with a text."""
    marked = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id") \
        .agg(F.min("quality").alias("quality"))
    counts = {r["quality"]: r["n"] for r in marked.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [marked.where(F.col("quality") == q).orderBy(*by_hash).limit(LABELLED) for q in (0, 1)]
    wanted = picked[0].unionByName(picked[1])
    chosen = docs.where("text IS NOT NULL AND text != ''").join(F.broadcast(wanted), "doc_id", "left_semi")
    rows = (_featured(chosen).dropDuplicates(["doc_id"]).join(F.broadcast(wanted), "doc_id")
            .orderBy(*by_hash).collect())
    y = np.array([r["quality"] for r in rows], np.int64)
    if not {0, 1} <= set(y.tolist()):
        return None
    text, meta = (np.array([r[c] for r in rows]) for c in ("x_text", "x_meta"))
    weight = (np.array([counts[0], counts[1]]) / np.bincount(y, minlength=2))[y]
    pool = unlabelled(docs, marked.select("doc_id"))
    pairs = pool.select("pair").distinct().count()
    model = exchange(text, meta, y, weight / weight.mean(),
                     lambda views, given: sure_rows(pool, views, given, max(EACH, GIVEN // max(pairs, 1))))
    discard(pool)
    return model


def score(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, score_text, score_meta, score
    (probabilities of a good document) and keep (1 if score >= 0.5).

    Null, empty and wordless texts score 0 and are not kept; null source,
    language or length are values of their own, as are columns that ``docs``
    lacks; repeated rows are repeated; long texts are read whole. Without
    labels of both classes every text with words scores 1. An empty table
    gives no rows."""
    model = model or fit(docs, labels)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch in batches:
            for part in textbytes.slices(batch, "text", textbytes.BLOCK_BYTES):
                x = text_features(part.column(1))
                worded = x[:, 0] > 0
                s = [np.ones(len(x))] * 3 if m is None else m.scores(x, meta_features(*part.columns[2:5]))
                both = np.where(worded, s[2], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(np.where(worded, v, 0.0)) for v in s[:2]), pa.array(both),
                     pa.array((both >= 0.5).astype(np.int32))],
                    ["doc_id", "score_text", "score_meta", "score", "keep"])

    return _columns(docs).mapInArrow(
        run, "doc_id long, score_text double, score_meta double, score double, keep int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (same columns) without the rows that are not kept: a filter in
    the scan, by the text, source, language and length of each row."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    at = docs.columns.index("text")

    def run(batches):
        m = held.value
        for batch in batches:
            for part in textbytes.slices(batch, "text", textbytes.BLOCK_BYTES):
                x = text_features(part.column(at))
                keep = x[:, 0] > 0
                if m is not None:
                    none = pa.nulls(part.num_rows, pa.string())
                    meta = [part.column(c) if c in part.schema.names else none for c in META]
                    keep &= m.scores(x, meta_features(*meta))[2] >= 0.5
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)

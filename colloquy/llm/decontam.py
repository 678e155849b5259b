"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is the set of its distinct five-word shingles (lower-cased A-Z, words
between white space). An item of fewer words is one shingle of its own length,
and documents probe with runs of that length too. The items are dealt into size
partitions. Every item is kept as its MinHash sketch: its k smallest
shingle hashes, where k is fixed by its size partition so that a document that
holds the wanted share of the item's shingles holds one of the k for certain
(it misses at most (1 - share) of n, and k is larger). A document probes all
partitions with its own shingles; that finds short items inside documents of
any length, as containment needs no likeness of the two sizes. Every candidate
is then verified by exact shingle containment on the words themselves.

The search is a scan of the documents: nothing is shuffled, and no document
meets another, so hot sources, copies and shared passages do not matter. The
items travel to the tasks in blocks of bounded size; a larger benchmark means
more blocks, each a scan of the documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes

SHINGLE = 5
SHARE = Fraction(8, 10)
#: Items of one block, and the characters of text that a block may hold (a
#: single longer item is a block of its own).
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 8_000_000

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str | None, size: int = SHINGLE) -> set[str]:
    """Distinct shingles as text; a shorter text is one shingle, an empty one none."""
    w = _WORD.findall((text or "").translate(_LOWER))
    if len(w) < size:
        return {" ".join(w)} if w else set()
    return {" ".join(w[i:i + size]) for i in range(len(w) - size + 1)}


def sketch_size(n: int, share: Fraction = SHARE) -> int:
    """k of the size partition of ``n`` shingles: partitions end at powers of
    two, and k covers what the largest size in it may miss, plus one."""
    top = 1 << max(0, (n - 1).bit_length())
    return top - math.ceil(share * top) + 1


class Sketches:
    """The sketches of the items that have shingles of one length: sorted
    hashes, and the items of each."""

    def __init__(self, length: int, numbers: list[int], texts: list[str], share: Fraction):
        self.length = length
        words, offsets = textbytes.word_hashes(pa.array(texts, pa.large_string()))
        hashes, edges = textbytes.shingle_hashes(words, offsets, length)
        keys, owners = [], []
        for k, number in enumerate(numbers):
            own = np.unique(hashes[edges[k]:edges[k + 1]])
            own = own[:sketch_size(len(own), share)]
            keys.append(own)
            owners.append(np.full(len(own), number))
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.keys, self.first, count = np.unique(keys[order], return_index=True, return_counts=True)
        self.last, self.owners = self.first + count, owners[order]

    def candidates(self, words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(row, item numbers) where a row has a hash of the items' sketches."""
        hashes, edges = textbytes.shingle_hashes(words, offsets, self.length)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hits = np.flatnonzero(self.keys[at] == hashes)
        rows = np.searchsorted(edges, hits, "right") - 1  # ascending
        begins = np.flatnonzero(np.diff(rows, prepend=-1))
        for a, b in zip(begins, [*begins[1:], len(hits)]):
            keys = np.unique(at[hits[a:b]])
            yield int(rows[a]), np.unique(np.concatenate([self.owners[self.first[k]:self.last[k]] for k in keys]))


class Index:
    """One block of items: their shingles, and the sketches by shingle length."""

    def __init__(self, items: list[tuple[int, str]], size: int = SHINGLE, share: Fraction = SHARE):
        self.share = share
        self.ids = [i for i, _ in items]
        self.sets = [shingles(t, size) for _, t in items]
        lengths: dict[int, list[int]] = {}
        for k, (_, t) in enumerate(items):
            if self.sets[k]:
                lengths.setdefault(min(size, len(_WORD.findall(t))), []).append(k)
        self.sketches = [Sketches(n, ks, [items[k][1] for k in ks], share) for n, ks in sorted(lengths.items())]

    def search(self, column: pa.Array) -> Iterator[tuple[int, int, int]]:
        """(row, item number, shared shingles) of every verified containment."""
        words, offsets = textbytes.word_hashes(column)
        for sketch in self.sketches:
            for row, found in sketch.candidates(words, offsets):
                own = shingles(column[row].as_py(), sketch.length)
                for k in found:
                    shared = len(self.sets[k] & own)
                    if shared >= self.share * len(self.sets[k]):
                        yield row, int(k), shared


def blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, in the order of their ids."""
    out, chars = [], 0
    for r in items.select(id_col, text_col).where(F.col(text_col).isNotNull()) \
            .orderBy(id_col, text_col).toLocalIterator():
        if out and (len(out) >= BLOCK_ITEMS or chars + len(r[1]) > BLOCK_CHARS):
            yield out
            out, chars = [], 0
        out.append((r[0], r[1]))
        chars += len(r[1])
    if out:
        yield out


def contained(docs: DataFrame, items: DataFrame, share: Fraction = SHARE, size: int = SHINGLE) -> DataFrame:
    """Every (doc_id, item_id, n_shared, n_item, containment) where the
    document holds at least ``share`` of the item's distinct shingles.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are not
    read. An item of fewer than ``size`` words is held where its words stand one
    after the other. Null and empty texts hold nothing and are in nothing. Repeated
    document rows give repeated results; repeated items are reported each. An
    empty table on either side gives no rows."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, n_shared long, n_item long, containment double"
    held = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    out = spark.createDataFrame([], schema)
    for block in blocks(items, "item_id", "text"):
        index = spark.sparkContext.broadcast(Index(block, size, share))

        def scan(batches, index=index):
            ix = index.value
            for batch in batches:
                for part in textbytes.slices(batch, "text"):
                    ids = part.column(0)
                    found = [(ids[r].as_py(), ix.ids[k], n, len(ix.sets[k]), n / len(ix.sets[k]))
                             for r, k, n in ix.search(part.column(1))]
                    cols = zip(*found) if found else [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(cols, (*[pa.int64()] * 4, pa.float64()))],
                        ["doc_id", "item_id", "n_shared", "n_item", "containment"])
        out = out.unionByName(held.mapInArrow(scan, schema))
    return out


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds an item (same columns). Every
    row is judged by its own text, in the scan, so rows of one id or of none do
    not go with each other; a null text stays."""
    at = docs.columns.index("text")
    out = docs
    for block in blocks(items, "item_id", "text"):
        index = docs.sparkSession.sparkContext.broadcast(Index(block))

        def scan(batches, index=index):
            for batch in batches:
                for part in textbytes.slices(batch, "text"):
                    keep = np.ones(part.num_rows, bool)
                    keep[[row for row, _, _ in index.value.search(part.column(at))]] = False
                    yield part.filter(pa.array(keep))
        out = out.mapInArrow(scan, docs.schema)
    return out

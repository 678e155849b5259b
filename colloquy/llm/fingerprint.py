"""Order-independent document fingerprints: a homomorphic multiset hash.

A text is the multiset of its paragraphs (the pieces between line breaks; an
empty text has none). Every paragraph is hashed to a wide vector and the
vectors are summed, each lane modulo a power of two, so

* texts with the same paragraphs in any order have equal fingerprints;
* a paragraph is inserted by adding its vector and deleted by subtracting it,
  without the rest of the text.

The vector has two blocks. ``EQUAL`` lanes modulo 2**64 hold a 512-bit digest
of the paragraph: they decide equality. ``LIKE`` lanes modulo 2**32 hold a
signed count of the paragraph's three-word shingles (no text is long enough to wrap one): the square distance of
two sums estimates how many shingles the texts do not share, which gives a
likeness between 0 and 1, with a standard error near 1/sqrt(LIKE).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes

EQUAL, LIKE, SHINGLE = 8, 256, 3
#: Characters of text put together before a block of rows is hashed.
BLOCK_CHARS = 2_000_000


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(EQUAL block, LIKE block) of every text; a row each."""
    pieces = [t.split("\n") if t else [] for t in texts]
    counts = np.array([len(p) for p in pieces], np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    equal = np.zeros((len(texts), EQUAL), np.uint64)
    flat = [q for p in pieces for q in p]
    if flat:
        raw = b"".join(hashlib.blake2b(q.encode(), digest_size=8 * EQUAL).digest() for q in flat)
        lanes = np.frombuffer(raw, "<u8").reshape(-1, EQUAL)
        edges = np.flatnonzero(counts)
        first = (np.cumsum(counts) - counts)[edges]
        equal[edges] = np.add.reduceat(lanes, first, axis=0)
    hashes, offsets = textbytes.shingle_hashes(
        *textbytes.word_hashes(pa.array(flat, pa.large_string())), SHINGLE)
    row = np.repeat(owner, np.diff(offsets))
    lane = (hashes & np.uint64(LIKE - 1)).astype(np.int64)
    sign = 1.0 - 2.0 * ((hashes >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    like = np.bincount(row * LIKE + lane, sign, len(texts) * LIKE).astype(np.int64)
    return equal, like.astype(np.uint32).reshape(len(texts), LIKE)


def pack(equal: np.ndarray, like: np.ndarray) -> list[str]:
    """Fingerprints as hex strings."""
    return [e.astype("<u8").tobytes().hex() + v.astype("<u4").tobytes().hex() for e, v in zip(equal, like)]


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    return np.frombuffer(raw, "<u8", EQUAL), np.frombuffer(raw, "<u4", LIKE, 8 * EQUAL)


def fingerprint(text: str | None) -> str:
    return pack(*vectors([text or ""]))[0]


def insert(fp: str, paragraph: str) -> str:
    """The fingerprint after adding one paragraph (that has no line break)."""
    (e, v), (pe, pv) = unpack(fp), _paragraph(paragraph)
    return pack([e + pe], [v + pv])[0]


def delete(fp: str, paragraph: str) -> str:
    """The fingerprint after taking one paragraph out again."""
    (e, v), (pe, pv) = unpack(fp), _paragraph(paragraph)
    return pack([e - pe], [v - pv])[0]


def _paragraph(paragraph: str) -> tuple[np.ndarray, np.ndarray]:
    if "\n" in paragraph:
        raise ValueError("a paragraph has no line break")
    equal, like = vectors([paragraph + "\n"])  # two paragraphs, the second empty
    empty = np.frombuffer(hashlib.blake2b(b"", digest_size=8 * EQUAL).digest(), "<u8")
    return equal[0] - empty, like[0]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row: 1 for equal fingerprints, else 1 - |a-b|^2 / (|a|^2+|b|^2)
    over the LIKE lanes, between 0 and 1."""
    x, y = a[1].view(np.int32).astype(np.float64), b[1].view(np.int32).astype(np.float64)
    apart = (a[1] - b[1]).view(np.int32).astype(np.float64)
    total = (x * x).sum(1) + (y * y).sum(1)
    near = 1.0 - (apart * apart).sum(1) / np.maximum(total, 1.0)
    same = (a[0] == b[0]).all(1)
    return np.where(same, 1.0, np.clip(near, 0.0, 1.0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; a null text counts as empty."""

    def run(batches):
        for b in batches:
            for part in textbytes.slices(b, "text"):
                texts = [t or "" for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pack(*vectors(texts)), pa.string())],
                                                 ["doc_id", "fingerprint"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def with_successors(docs: DataFrame) -> DataFrame:
    """(chunk, tail, doc_id, text), partitioned by chunk and sorted inside:
    every row once with tail 0, and after the rows of each chunk the first rows
    of the next one with tail 1. So each row finds its successor inside its
    partition, and a text travels once.

    Chunks are ranges of doc_id between approximate quantiles, four for each
    shuffle partition; the driver holds one id for each chunk. A null id counts
    as the smallest, and the chunk after the last one is the first."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("long")).alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 4 * parts
    cuts = rows.agg(F.percentile_approx("doc_id", [(i + 1) / n for i in range(n - 1)], 20 * n).alias("q")).first()["q"]
    splits = sorted({float(c) for c in cuts or []})
    place = Bucketizer(splits=[-float("inf"), *splits, float("inf")] if splits else
                       [-float("inf"), 0.0, float("inf")], inputCol="x", outputCol="chunk")

    def chunked(df):
        return place.transform(df.withColumn("x", F.col("doc_id").cast("double"))) \
            .withColumn("chunk", F.col("chunk").cast("int")).drop("x")

    firsts = sorted((r["chunk"], r["first_id"]) for r in chunked(rows.select("doc_id")).groupBy("chunk")
                    .agg(F.min("doc_id").alias("first_id")).collect())
    before = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]  # of the first: the last
    heads = spark.createDataFrame(before, "first_id long, tail_of int")
    own = F.array(F.struct(F.col("chunk"), F.lit(0).alias("tail")))
    also = F.array(F.struct(F.col("tail_of").alias("chunk"), F.lit(1).alias("tail")))
    copies = F.when(F.col("first_id").isNull(), own).otherwise(F.concat(own, also))
    placed = (chunked(rows).join(F.broadcast(heads), F.col("doc_id") == F.col("first_id"), "left")
              .select(F.explode(copies).alias("c"), "doc_id", "text")
              .select("c.chunk", "c.tail", "doc_id", "text"))
    return placed.repartition(parts, "chunk").sortWithinPartitions("chunk", "tail", "doc_id", "text")


def edited_text(text: str, after: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as
    many (or all) of ``after``."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def compare_edits(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): n_chars, the fingerprint of its
    text, of the edited text, and the likeness of the first to the second
    (near_edited) and to the next row's (near_next).

    The next row is the one after it by doc_id, then text, and after the last
    the first; a single row follows itself. Null texts count as empty, a null
    id as the smallest; repeated rows follow each other; an empty table gives
    no rows, and other columns are not read."""
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def block(rows: list[tuple], after: tuple) -> pa.RecordBatch:
        texts = [r[3] for r in rows]
        follow = [*texts[1:], after[3]]
        own = vectors([*texts, after[3]])
        edits = [edited_text(t, f) for t, f in zip(texts, follow)]
        changed = vectors(edits)
        mine, other = (own[0][:-1], own[1][:-1]), (own[0][1:], own[1][1:])
        ids = [r[2] if r[2] != -(1 << 63) else None for r in rows]
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
            pa.array(pack(*mine), pa.string()), pa.array(pack(*changed), pa.string()),
            pa.array(likeness(mine, changed)), pa.array(likeness(mine, other)),
        ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows that wait for their successor, all of one chunk
        chars = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (row[1] == 1 or chars > BLOCK_CHARS):
                    yield block(held, row)
                    held, chars = [], 0
                if row[1] == 0:
                    held.append(row)
                    chars += len(row[3])
        if held:
            raise RuntimeError("a chunk has no row after its last one")

    return with_successors(docs).mapInArrow(run, schema)

"""Byte-level BPE encoding and decoding over a distinct-word table.

BPE works inside one word of the tokenizer's split pattern, so a word has the
same ids wherever it stands. The texts are split in the tasks; every distinct
word is encoded once; the ids are joined back by position; decoding looks up
each id's piece in the id-to-piece table.

The words of a corpus are very unevenly frequent, and the join is laid out
for that (no word, however common, makes a hot key):

* *common words*: the most frequent ``COMMON`` words (counted over all texts)
  are encoded in one small job; their table has a fixed largest size and goes
  to every task, where a position finds its ids by the word's hash;
* *rare words*: every other position becomes a row (document, position, word).
  The rows of a word are grouped, the word is encoded once, and its ids go
  back to the positions by a join on the document. A rare word's group is
  bounded by the frequency of the last common word.

A text travels once, compressed, to meet its rare ids. The number of common
words changes only how much is shuffled, never a result: a position is either
found in the table or has a row.

Splitting is done on code points with numpy: a class per character (letter,
number, white space, other), runs of a class, the space that joins the run
after it, and English contractions, as the byte-level split pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
has them. Special tokens of the vocabulary are cut out of the text first.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from . import textbytes

#: Common words: how many, and the longest (UTF-8 bytes) that may be one.
COMMON, COMMON_BYTES = 1 << 20, 32
#: A task drops words seen once from its counts whenever it holds so many.
COUNTED = 1 << 19

LETTER, NUMBER, SPACE, OTHER, SPECIAL = range(5)
#: Code points with the property White_Space.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Contractions of the split pattern.
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]


@cache
def _classes() -> np.ndarray:
    """The class of every code point. Code points that one Unicode version
    assigns and another does not are put to the tokenizers library itself."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for run in regex.finditer(r"[\p{L}\p{N}]+", points):
        for ch in run.group():
            if table[ord(ch)] == OTHER:
                table[ord(ch)] = LETTER if len(split("a" + ch)) == 1 else NUMBER if len(split("1" + ch)) == 1 else OTHER
    table[WHITE] = SPACE
    return table


@cache
def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself where it is printable, else the next free one from 256."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(free)) for b in range(256)]


class Codec:
    """A byte-level BPE vocabulary: splitting, encoding of words, pieces of ids."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.tokenizer = Tokenizer.from_str(text)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        back = {ch: b for b, ch in enumerate(alphabet)}
        self._alphabet = {b: ord(ch) for b, ch in enumerate(alphabet)}
        vocabulary = {**spec["model"]["vocab"], **self.special}
        self.size = max(vocabulary.values()) + 1
        pieces = [b""] * self.size
        for piece, i in vocabulary.items():
            pieces[i] = bytes(back[ch] for ch in piece) if all(ch in back for ch in piece) else piece.encode()
        self.pieces = Ragged.of(pieces)
        self.decimals = Ragged.of([b",%d" % i for i in range(self.size)])

    def encode_word(self, word: str) -> np.ndarray:
        if word in self.special:
            return np.array([self.special[word]], np.uint32)
        mapped = word.encode().decode("latin-1").translate(self._alphabet)
        return np.array([t.id for t in self.tokenizer.model.tokenize(mapped)], np.uint32)

    def split(self, column: pa.Array) -> Words:
        raw, offsets = textbytes.buffer_of(column)
        raw = raw[offsets[0]:offsets[-1]]
        text = raw.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        rows = before[offsets - offsets[0]]
        return Words(text, points, rows, self._starts(text, points, rows))

    def _starts(self, text: str, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        n = len(points)
        kind = _classes()[points]
        cut = np.zeros(n + 1, bool)
        cut[rows] = True
        for token in self.special:
            at = text.find(token)
            while at >= 0:
                end = at + len(token)
                inside = np.searchsorted(rows, at, "right") == np.searchsorted(rows, end, "left")
                if inside:
                    kind[at:end] = SPECIAL
                    cut[[at, end]] = True
                at = text.find(token, end if inside else at + 1)
        cut, ends = cut[:n], cut[1:]  # ends[i]: a new segment begins after i
        start = cut.copy()
        start[1:] |= kind[1:] != kind[:-1]
        after = np.flatnonzero(start[1:] & ~cut[1:] & (kind[:-1] == SPACE)) + 1  # runs after white space
        start[after - 1] = True
        start[after[points[after - 1] == 32]] = False
        quotes = np.flatnonzero((points == 39) & start & ~ends)
        quotes = quotes[kind[quotes + 1] == LETTER]
        if len(quotes):
            padded = np.concatenate([points, [0, 0]])
            for c in CONTRACTIONS:
                hit = quotes[padded[quotes + 1] == ord(c[1])]
                if len(c) == 3:
                    hit = hit[(padded[hit + 2] == ord(c[2])) & ~ends[hit + 1]]
                start[hit + 1] = False
                rest = hit + len(c)
                hit = rest[(rest < n)]
                start[hit] = True
        return np.flatnonzero(start)


class Words:
    """The words of a column slice: code point spans, hashes, row offsets."""

    def __init__(self, text: str, points: np.ndarray, rows: np.ndarray, starts: np.ndarray):
        self.text, self.starts = text, starts
        self.ends = np.append(starts[1:], len(points)) if len(starts) else starts
        self.offsets = np.searchsorted(starts, rows)
        self.hashes = _hash(points, self.starts, self.ends)

    def word(self, i: int) -> str:
        return self.text[self.starts[i]:self.ends[i]]


def _hash(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(points)
    base = textbytes._BASE
    power = textbytes._POW if n <= len(textbytes._POW) else textbytes._powers(base, n)
    inverse = textbytes._INV if n <= len(textbytes._INV) else textbytes._powers(pow(base, -1, 1 << 64), n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_point_values()[points] * power[:n], out=sums[1:])
    value = (sums[ends] - sums[starts]) * inverse[starts]
    return textbytes.mix(value + (ends - starts).astype(np.uint64) * np.uint64(base))


@cache
def _point_values() -> np.ndarray:
    return textbytes.mix(np.arange(0x110000, dtype=np.uint64) + np.uint64(textbytes._BASE))


def word_hash(words: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    edges = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    out = [_hash(points[edges[i]:edges[i + 1024 if i + 1024 < len(words) else -1]],
                 edges[i:-1][:1024] - edges[i], edges[i + 1:][:1024] - edges[i])
           for i in range(0, len(words), 1024)]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Ragged:
    """Rows of different lengths in one flat array."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.flat, self.starts, self.sizes = flat, starts, sizes

    @staticmethod
    def of(rows: list[bytes]) -> Ragged:
        sizes = np.array([len(r) for r in rows], np.int64)
        return Ragged(np.frombuffer(b"".join(rows), np.uint8), np.cumsum(sizes) - sizes, sizes)

    def take(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the rows ``index`` one after the other, where each ends)."""
        sizes = self.sizes[index]
        ends = np.cumsum(sizes)
        if not len(ends):
            return self.flat[:0], ends
        shift = np.repeat(self.starts[index] - (ends - sizes), sizes)
        return self.flat[np.arange(ends[-1]) + shift], ends


class Table:
    """Encoded common words: sorted hashes and the ids of each."""

    def __init__(self, words: list[str], ids: list[bytes]):
        hashes = word_hash(words)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        sizes = np.array([len(i) // 4 for i in ids], np.int64)[order]
        flat = np.frombuffer(b"".join(ids[k] for k in order), np.uint32)
        self.ids = Ragged(flat, np.cumsum(sizes) - sizes, sizes)

    def __getstate__(self):
        """What travels: hashes, sizes of one byte (a common word has few ids),
        and ids as narrow as they allow."""
        flat = self.ids.flat
        narrow = flat.astype(np.uint16) if not len(flat) or flat.max() < 1 << 16 else flat
        return self.keys, self.ids.sizes.astype(np.uint8), narrow

    def __setstate__(self, state):
        self.keys, sizes, flat = state
        sizes = sizes.astype(np.int64)
        self.ids = Ragged(flat.astype(np.uint32), np.cumsum(sizes) - sizes, sizes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, or -1."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        some, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        return np.where(self.keys[at] == some, at, -1)[back]


_KEPT: dict[str, Codec] = {}


def _codec(text: Broadcast) -> Codec:
    """One codec for a worker process and vocabulary."""
    key = hashlib.sha256(text.value.encode()).hexdigest()
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Codec(text.value)
    return _KEPT[key]


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file, read by the driver and sent to the tasks (a file of
    fixed size, so executors need not have it)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _encoder(vocab: Broadcast):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocab)
        for b in batches:
            ids = [codec.encode_word(w).tobytes() for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary())], [*b.schema.names, "ids"])
    return encode


def word_counts(docs: DataFrame, vocab: Broadcast) -> DataFrame:
    """(word, n) for the frequent words: every task counts all words of its
    texts and leaves out those it saw once."""

    def count(batches):
        codec = _codec(vocab)
        held: dict[str, int] = {}
        for batch in batches:
            for part in textbytes.slices(batch, "text", textbytes.BLOCK_BYTES):
                words = codec.split(part.column(0))
                _, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
                for i, k in zip(first.tolist(), n.tolist()):
                    w = words.word(i)
                    held[w] = held.get(w, 0) + k
                if len(held) > COUNTED:
                    held = {w: k for w, k in held.items() if k > 1}
        rows = [(w, k) for w, k in held.items() if k > 1 and len(w) <= COMMON_BYTES]
        for i in range(0, len(rows), 100_000):
            some = rows[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()),
                                              pa.array([k for _, k in some], pa.int64())], ["word", "n"])

    seen = docs.select("text").where(F.col("text").isNotNull()).mapInArrow(count, "word string, n long")
    return seen.groupBy("word").agg(F.sum("n").alias("n"))


def common_words(docs: DataFrame, vocab: Broadcast, limit: int = COMMON) -> Broadcast:
    """The ``limit`` most frequent words with their ids. A word has at most
    COMMON_BYTES bytes and as many ids, which bounds the table."""
    spark = docs.sparkSession
    top = (word_counts(docs, vocab).where(F.octet_length("word") <= COMMON_BYTES)
           .orderBy(F.desc("n"), "word").limit(limit).select("word"))
    table = top.mapInArrow(_encoder(vocab), "word string, ids binary").toArrow()
    return spark.sparkContext.broadcast(Table(table.column("word").to_pylist(), table.column("ids").to_pylist()))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key that finds a row again: its id and its text's hash."""
    return docs.withColumns({"k1": F.coalesce(F.col("doc_id"), F.lit(-1).cast("long")),
                             "k2": F.xxhash64("text")})


def rare_positions(docs: DataFrame, vocab: Broadcast, common: Broadcast) -> DataFrame:
    """(k1, k2, pos, word) of every position whose word is not common."""

    def scan(batches):
        codec, table = _codec(vocab), common.value
        for batch in batches:
            for part in textbytes.slices(batch, "text", textbytes.BLOCK_BYTES):
                words = codec.split(part.column(0))
                at = np.flatnonzero(table.find(words.hashes) < 0)
                row = np.searchsorted(words.offsets, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(row)), part.column(2).take(pa.array(row)),
                     pa.array((at - words.offsets[row]).astype(np.int32)),
                     pa.array([words.word(i) for i in at.tolist()], pa.string())], ["k1", "k2", "pos", "word"])

    return (_keyed(docs).where(F.col("text").isNotNull()).select("text", "k1", "k2")
            .mapInArrow(scan, "k1 long, k2 long, pos int, word string"))


def _width(codec: Codec) -> int:
    """Bytes of an id on its way."""
    return 2 if codec.size <= 1 << 16 else 4


def rare_ids(docs: DataFrame, vocab: Broadcast, common: Broadcast) -> DataFrame:
    """(k1, k2, rare): the places of every document's rare words, each the
    position (4 bytes) and the ids, packed to move less. Rows that repeat a
    document have the same places, which are kept once."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = rare_positions(docs, vocab, common).repartition(parts, "word").sortWithinPartitions("word")

    def encode(batches):
        codec, last, packed = _codec(vocab), None, b""
        kind = f"<u{_width(codec)}"
        for b in batches:
            places = []
            for word, pos in zip(b.column(3).to_pylist(), b.column(2).to_pylist()):
                if word != last:  # sorted, so each distinct word is encoded once
                    last, packed = word, codec.encode_word(word).astype(kind).tobytes()
                places.append(pos.to_bytes(4, "little") + packed)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(places, pa.binary())],
                                             ["k1", "k2", "place"])

    return (words.mapInArrow(encode, "k1 long, k2 long, place binary")
            .groupBy("k1", "k2").agg(F.collect_set("place").alias("rare")))


def _unpacked(places: pa.Array, width: int) -> tuple[np.ndarray, Ragged]:
    """(positions, ids) of packed places."""
    offsets = np.frombuffer(places.buffers()[1], np.int32)[places.offset:places.offset + len(places) + 1]
    if not len(places):
        return np.zeros(0, np.int64), Ragged.of([])
    data = np.frombuffer(places.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    starts, sizes = (offsets[:-1] - offsets[0]).astype(np.int64), (np.diff(offsets) - 4) // width
    keep, pos = np.ones(len(data), bool), np.zeros(len(starts), np.int64)
    for k in range(4):
        pos |= data[starts + k].astype(np.int64) << (8 * k)
        keep[starts + k] = False
    ids = np.frombuffer(data[keep].tobytes(), f"<u{width}").astype(np.uint32)
    return pos, Ragged(ids, np.cumsum(sizes) - sizes, sizes.astype(np.int64))


def _compressed(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, z): the texts compressed, for the one shuffle they take."""

    def pack(batches):
        z = zstandard.ZstdCompressor(level=9)
        for b in batches:
            packed = [z.compress((t or "").encode()) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(packed, pa.binary())],
                                             ["doc_id", "k1", "k2", "z"])

    return _keyed(docs).select("doc_id", "k1", "k2", "text").mapInArrow(
        pack, "doc_id long, k1 long, k2 long, z binary")


def _token_rows(codec: Codec, table: Table, texts: pa.Array, rare: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, where each row ends): the position join of one slice."""
    words = codec.split(texts)
    at = table.find(words.hashes)
    gaps = np.flatnonzero(at < 0)
    owner = np.asarray(pc.list_parent_indices(rare))
    pos, packed = _unpacked(rare.flatten(), _width(codec))
    places, which = np.unique(words.offsets[owner] + pos, return_index=True)  # repeated rows repeat their positions
    if len(places) != len(gaps) or (places != gaps).any():
        raise RuntimeError("a position has no ids")
    extra, sizes = packed.take(which)[0].astype(np.uint32), packed.sizes[which]
    at[gaps] = len(table.ids.sizes) + np.arange(len(gaps))
    both = Ragged(np.concatenate([table.ids.flat, extra]),
                  np.concatenate([table.ids.starts, len(table.ids.flat) + np.cumsum(sizes) - sizes]),
                  np.concatenate([table.ids.sizes, sizes]))
    ids, ends = both.take(at)
    ends = np.concatenate([[0], ends])
    return ids, ends[words.offsets]


def _assembled(docs: DataFrame, path: str, finish, schema: str, common: int) -> DataFrame:
    """Every row of ``docs`` through ``finish(codec, doc ids, ids, edges)``."""
    vocab = vocabulary(docs.sparkSession, path)
    table = common_words(docs, vocab, common)
    joined = _compressed(docs).join(rare_ids(docs, vocab, table), ["k1", "k2"], "left")

    def run(batches):
        codec, z = _codec(vocab), zstandard.ZstdDecompressor()
        for batch in batches:
            texts = pa.array([z.decompress(x).decode() for x in batch.column(1).to_pylist()], pa.large_string())
            rare = batch.column(2)
            rare = pa.ListArray.from_arrays(  # a null list counts as an empty one
                pa.array(np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(rare), 0)))]),
                         pa.int32()), rare.flatten())
            whole = pa.RecordBatch.from_arrays([batch.column(0), texts, rare], ["doc_id", "text", "rare"])
            for part in textbytes.slices(whole, "text", textbytes.BLOCK_BYTES):
                ids, edges = _token_rows(codec, table.value, part.column(1), part.column(2))
                yield finish(codec, part.column(0), ids, edges)

    return joined.select("doc_id", "z", "rare").mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, common: int = COMMON) -> DataFrame:
    """(doc_id, ids): the token ids of every row's whole text, as the
    vocabulary's own tokenizer gives them without added special tokens.

    Null and empty texts have no ids; repeated rows are repeated; columns other
    than doc_id and text are not read; an empty table gives no rows."""

    def finish(codec, doc_ids, ids, edges):
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_arrays([doc_ids, lists], ["doc_id", "ids"])

    return _assembled(docs, path, finish, "doc_id long, ids array<int>", common)


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``text``: the pieces of the ids put together through the
    id-to-piece table, special tokens kept. Bytes that are not UTF-8 become the
    replacement character; null ids give a null text."""
    vocab = vocabulary(rows.sparkSession, path)
    out = rows.schema.simpleString()[len("struct<"):-1]

    def run(batches):
        pieces = _codec(vocab).pieces
        for b in batches:
            lists = b.column(b.schema.get_field_index(ids))
            texts = [None if x is None else
                     pieces.take(np.array(x, np.int64))[0].tobytes().decode(errors="replace")
                     for x in lists.to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             [*b.schema.names, "text"])

    return rows.mapInArrow(run, out.replace(",", ", ") + ", text:string")


def digests(docs: DataFrame, path: str, common: int = COMMON) -> DataFrame:
    """Encoding, then decoding, of every row, kept as digests: doc_id,
    n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256
    (of the decoded text in UTF-8). Cases as in ``encode``."""

    def finish(codec, doc_ids, ids, edges):
        text, text_ends = codec.decimals.take(ids)
        piece, piece_ends = codec.pieces.take(ids)
        text_at = np.concatenate([[0], text_ends])[edges].tolist()
        piece_at = np.concatenate([[0], piece_ends])[edges].tolist()
        text, piece = memoryview(text), memoryview(piece)
        rows = range(len(edges) - 1)
        return pa.RecordBatch.from_arrays([
            doc_ids, pa.array(np.diff(edges), pa.int64()),
            pa.array([hashlib.sha256(text[text_at[i] + 1:text_at[i + 1]]).hexdigest() for i in rows]),
            pa.array([_valid_sha(piece[piece_at[i]:piece_at[i + 1]]) for i in rows]),
        ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _assembled(docs, path, finish, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                      common)


def _valid_sha(raw: memoryview) -> str:
    return hashlib.sha256(bytes(raw).decode(errors="replace").encode()).hexdigest()

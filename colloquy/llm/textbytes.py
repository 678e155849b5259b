"""Words and word shingles of whole Arrow string columns, hashed with numpy.

A word is a longest run of bytes outside ``0x20`` and ``0x09-0x0D``, with A-Z
lower-cased; on UTF-8 that is the same as ``[^\\x20\\x09-\\x0D]+`` on code
points. The work is done on the column's byte buffer, a bounded block at a
time, so no Python object is made per word.

Hashes are 64-bit: words are polynomials over random byte values modulo
2**64, mixed with their length; shingles mix the hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of text hashed at once; a worker holds some 40 times as much, two tables included.
BLOCK_BYTES = 1 << 18
#: Bytes of text in a slice of a batch, where no less is asked for.
SLICE_BYTES = 1 << 23
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    v = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_BASE))
    v[65:91] = v[97:123]
    return v


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_VALUES = _byte_values()
_POW = _powers(_BASE, BLOCK_BYTES)
_INV = _powers(pow(_BASE, -1, 1 << 64), BLOCK_BYTES)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _spans(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``raw``; a word never crosses a cut."""
    inside = ~SEPARATOR[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hash_block(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(raw)
    power, inverse = (_POW, _INV) if n <= BLOCK_BYTES else (
        _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[raw] * power[:n], out=sums[1:])
    value = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets of each row's words)."""
    raw, offsets = buffer_of(column)
    at, stop = int(offsets[0]), int(offsets[-1])
    parts, begins = [], []
    while at < stop:
        end = min(at + BLOCK_BYTES, stop)
        if end < stop:  # go back to a separator or a row's start; a longer word makes a longer block
            row = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            gaps = np.flatnonzero(SEPARATOR[raw[at:end]])
            cut = max(row, at + int(gaps[-1]) + 1 if len(gaps) else at)
            while cut <= at:
                seen, end = end, min(end + BLOCK_BYTES, stop)
                gaps = np.flatnonzero(SEPARATOR[raw[seen:end]])
                limits = [seen + int(gaps[0]) + 1] if len(gaps) else []
                nxt = offsets[(offsets > at) & (offsets <= end)]
                limits += [int(nxt[0])] if len(nxt) else []
                cut = min(limits) if limits else (stop if end == stop else at)
            end = cut
        block = raw[at:end]
        cuts = offsets[(offsets > at) & (offsets < end)] - at
        starts, ends = _spans(block, cuts)
        parts.append(_hash_block(block, starts, ends))
        begins.append(starts + at)
        at = end
    begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(begin, offsets)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``size`` words, offsets of each row's shingles), in
    text order. A row with fewer words has its whole sequence as one shingle; a
    row without words has none."""
    n = np.diff(offsets)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    out_offsets = np.concatenate([[0], np.cumsum(count)])
    total = len(words)
    if not total:
        return np.zeros(0, np.uint64), out_offsets
    runs = np.zeros(total, np.uint64)
    for j in range(size):
        mult = np.uint64((_BASE * (2 * j + 1) * 0xD1342543DE82EF95 | 1) & _MASK)
        m = total - j
        if m > 0:
            runs[:m] += mix(words[j:] * mult) if j else words * mult
    index = np.arange(out_offsets[-1]) - np.repeat(out_offsets[:-1] - offsets[:-1], count)
    out = mix(runs[index])
    for row in np.flatnonzero((n > 0) & (n < size)):
        value = np.array([n[row]], np.uint64)
        for j in range(offsets[row], offsets[row + 1]):
            value = mix(value * np.uint64(_BASE) + words[j:j + 1])
        out[out_offsets[row]] = value[0]
    return out, out_offsets


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``limit`` bytes of text, or one row."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(edges, edges[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end

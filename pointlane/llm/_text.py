"""Vectorised work on the UTF-8 bytes of whole Arrow columns of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes worked on at once; bounds the temporary arrays whatever a text's length.
SLICE = 1 << 18
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1 + column.offset)[column.offset :] if n else np.zeros(1, np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_table(separators: bytes, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(is a word's byte, 64-bit value of each byte); A-Z get the values of a-z."""
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold_case:
        values[65:91] = values[97:123]
    word = np.ones(256, bool)
    word[list(separators)] = False
    return word, values


#: ASCII white space: what separates words of the shingle operators.
SPACE_WORDS = byte_table(b" \t\n\v\f\r")
#: All ASCII but letters and digits separates.
ALNUM_WORDS = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, table=SPACE_WORDS, prefix: int = 0) -> tuple[np.ndarray, ...]:
    """(64-bit hash of each word in order, first word of each text and the end).

    With ``prefix``, also the hash of each word's first so many bytes.

    A polynomial over random byte values, taken from running sums: the same
    word has the same hash wherever it stands. Memory beyond the result is
    bounded by SLICE (or the longest word).
    """
    is_word, values = table
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)) + (np.zeros(0, np.uint64),) * bool(prefix)
    word = is_word[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = offsets[:-1]
    heads = heads[heads < n]
    first[heads] = word[heads]
    last = word.copy()
    last[:-1] &= ~word[1:]
    tails = offsets[1:] - 1
    tails = tails[tails >= 0]
    last[tails] = word[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    heads = np.empty(len(starts) if prefix else 0, np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, side="right")))
        low, high = int(starts[at]), int(ends[to - 1])
        powers = np.full(high - low + 1, _P, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * powers[:-1], out=sums[1:])
        inverse = np.full(high - low + 1, _P_INV, np.uint64)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)
        s, e = starts[at:to] - low, ends[at:to] - low
        hashes[at:to] = mix64((sums[e] - sums[s]) * inverse[s])
        if prefix:
            heads[at:to] = mix64((sums[np.minimum(e, s + prefix)] - sums[s]) * inverse[s])
        at = to
    return (hashes, np.searchsorted(starts, offsets)) + ((heads,) if prefix else ())


def slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each (one row at least)."""
    if len(column) == 0:
        return
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64))
    at = 0
    while at < len(column):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield at, to
        at = to

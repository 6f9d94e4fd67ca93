"""Words of whole Arrow columns of texts, as Arrow values and local ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ._text import slices, text_bytes

_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[list(b" \t\n\v\f\r")] = False

#: Bytes of text split into words at once.
PART = 1 << 20


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(every word in order as large_binary, index of each text's first word and the end); nulls have no words.

    A word is a maximal run of bytes that aren't ASCII white space; case stays.
    """
    data, offsets = text_bytes(column)
    word = _WORD_BYTE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = offsets[:-1]
    heads = heads[heads < len(data)]
    first[heads] = word[heads]
    starts = np.flatnonzero(first)
    inside = np.concatenate([[0], np.cumsum(word)])
    ends = np.append(inside[starts], inside[-1])
    letters = np.ascontiguousarray(data[word])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.ascontiguousarray(ends.astype(np.int64))), pa.py_buffer(letters)])
    return words, np.searchsorted(starts, offsets)


def word_ids(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(id of every word, distinct words by id, first word of each text and the end).

    The text is split by parts of PART bytes, so that temporary arrays stay small beside the words.
    """
    parts, firsts, done = [], [np.zeros(1, np.int64)], 0
    for low, high in slices(column, PART):
        words, first = split_words(column.slice(low, high - low))
        parts.append(words)
        firsts.append(first[1:] + done)
        done += len(words)
    if not done:
        return np.zeros(0, np.int64), pa.array([], pa.large_binary()), np.concatenate(firsts)
    encoded = pa.chunked_array(parts, pa.large_binary()).dictionary_encode().combine_chunks()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.chunk(0)
    return np.asarray(encoded.indices).astype(np.int64), encoded.dictionary, np.concatenate(firsts)


def spelled(ids: np.ndarray, vocabulary: pa.Array, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of every text joined by one space."""
    words = vocabulary.take(pa.array(ids[keep])).cast(pa.large_binary())
    n = len(words)
    at = np.frombuffer(words.buffers()[1], np.int64, n + 1 + words.offset)[words.offset :] if n else np.zeros(1, np.int64)
    letters = np.frombuffer(words.buffers()[2], np.uint8)[at[0] : at[-1]] if n and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    spaced = np.full(len(letters) + n, 32, np.uint8)
    spaced[np.arange(len(letters)) + np.repeat(np.arange(n), np.diff(at))] = letters
    kept = np.concatenate([[0], np.cumsum(keep)])[first]
    # Every word is followed by a space here; the last one of a text is cut off.
    begin, end = at[kept[:-1]] + kept[:-1], at[kept[1:]] + kept[1:]
    end = np.maximum(begin, end - 1)
    inside = np.ones(len(spaced) + 1, bool)
    inside[end[kept[1:] > kept[:-1]]] = False
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_utf8(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(spaced[inside[:-1]]))])

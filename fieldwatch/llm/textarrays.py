"""Words and fingerprints of many texts at once, as numpy arrays.

A slice of texts is one byte buffer with offsets. Words (maximal runs of bytes
outside ``[\\x20\\x09-\\x0D]``, which never split a UTF-8 character) become start
and end positions in it, and strings are named by 64-bit fingerprints taken as
differences of one running sum, so no Python object is made per word.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from fieldwatch.llm.common import worker_store

SLICE = 2_000_000
KEPT_POWERS = 1 << 22

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base ** k modulo 2 ** 64 for k < n, kept in the worker."""
    store = worker_store("powers")
    have = store.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = np.ones(size, np.uint64)
        filled = 1
        while filled < size:  # doubling: each half is the other times base ** filled
            out[filled:2 * filled] = out[:filled] * np.uint64(pow(base, filled, 1 << 64))
            filled *= 2
        have = out
        if size <= KEPT_POWERS:  # those of a very long text go with it
            store[base] = out
    return have[:n]


class Fingerprints:
    """Fingerprints of substrings of ``values``: equal substrings have equal ones
    wherever they stand; ``seed`` picks the function."""

    def __init__(self, values: np.ndarray, seed: int):
        base = ((seed * 2 + 1) * _ODD | 1) % (1 << 64) & ~6 | 5  # 5 modulo 8: of full order
        self.inverse = pow(base, -1, 1 << 64)
        if values.dtype == np.uint8:
            table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64((seed * 2 + 1) * 0xD1342543DE82EF95 % (1 << 64)))
            codes = table[values]
        else:
            codes = mix(values ^ np.uint64((seed + 1) * 0xD1342543DE82EF95 % (1 << 64)))
        codes *= powers(base, len(codes))
        self.total = np.empty(len(codes) + 1, np.uint64)
        self.total[0] = 0
        np.cumsum(codes, out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        part = self.total[ends] - self.total[starts]
        part *= powers(self.inverse, len(self.total))[starts]
        part += (ends - starts).astype(np.uint64) * np.uint64(_ODD)
        return mix(part)


class Words(NamedTuple):
    data: np.ndarray  # all bytes
    offsets: np.ndarray  # of the texts in data
    inside: np.ndarray  # is this byte part of a word
    starts: np.ndarray  # of the words in data
    ends: np.ndarray
    first: np.ndarray  # of the texts' words in starts


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of an array of strings without nulls."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array) -> Words:
    data, offsets = bytes_of(texts)
    inside = ~_SPACE[data]
    # a word starts where the byte before it is a space or belongs to another text
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, inside, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(words: Words, seed: int = 1) -> np.ndarray:
    return Fingerprints(words.data, seed).of(words.starts, words.ends)


def slices(batch: pa.RecordBatch, text_at: int, size: int = SLICE):
    """The batch in runs of rows with at most ``size`` bytes of text, or one row."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.cast(pc.binary_length(batch.column(text_at)), pa.int64()), 0).to_numpy()
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(at, stop - at)
        at = stop

"""Words and word-window fingerprints of Arrow text columns, as whole-batch array arithmetic.

A word is a longest run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return.
Texts are handled a few megabytes at a time, so memory depends on the longest text and not on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _letters(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: One table of byte weights and one odd base for each independent fingerprint.
_LANES = [(_letters(11), np.uint64(0x9E3779B97F4A7C15)), (_letters(23), np.uint64(0xD6E8FEB86659FD93))]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts in order. ``first[i]:first[i + 1]`` are the words of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray
    hash: list[np.ndarray]

    def grams(self, n: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Start word and fingerprint of every n-word window that stays in one text."""
        count = len(self.start) - n + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h, base = self.hash[lane], _LANES[lane][1]
        total = np.zeros(count, np.uint64)
        for j in range(n):
            total = total * base + h[j:j + count]
        inside = self.text[:count] == self.text[n - 1:]
        at = np.flatnonzero(inside)
        return at, mixed(total[at] + np.uint64(n))


def joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    kept = np.flatnonzero(keep)
    owner, length = words.text[kept], words.end[kept] - words.start[kept]
    more = np.zeros(len(kept), np.int64)
    more[:-1] = owner[:-1] == owner[1:]
    total = np.concatenate(([0], np.cumsum(length + more)))
    parts, at = [], 0
    while at < len(kept):
        to = max(at + 1, int(np.searchsorted(total, total[at] + CHUNK_BYTES, "right")) - 1)
        size = (length + more)[at:to]
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        blank = within == np.repeat(length[at:to], size)
        source = within + np.repeat(words.start[kept[at:to]], size)
        source[blank] = 0
        letters = words.data[source]
        letters[blank] = 0x20
        parts.append(letters)
        at = to
    data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    offsets = total[np.searchsorted(owner, np.arange(len(words.first)), "left")]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]) \
        .cast(pa.string())


def binary(column: pa.Array) -> pa.Array:
    """UTF-8 bytes of a text column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())


def split(column: pa.Array, lower: bool = False, lanes: int = 1) -> Words:
    column = binary(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = ~space[edges]
    stops = ~space
    stops[:-1] &= space[1:]
    edges = offsets[1:][offsets[1:] > 0] - 1
    stops[edges] = ~space[edges]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(start, offsets, "left")
    text = np.repeat(np.arange(len(column)), np.diff(first))
    hashes = [np.zeros(len(start), np.uint64) for _ in range(lanes)]
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + CHUNK_BYTES, "right")))
        s, length = start[at:to], end[at:to] - start[at:to]
        before = np.cumsum(length) - length
        within = np.arange(int(length.sum())) - np.repeat(before, length)
        letters = data[within + np.repeat(s, length)]
        for lane, (weights, base) in enumerate(_LANES[:lanes]):
            powers = np.full(int(length.max()), base, np.uint64)
            powers[0] = 1
            terms = weights[letters] * np.cumprod(powers, dtype=np.uint64)[within]
            hashes[lane][at:to] = mixed(np.add.reduceat(terms, before) + length.astype(np.uint64))
        at = to
    return Words(data, start, end, text, first, hashes)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive parts of a few megabytes of the text column, a longer text alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    total, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def window_best(at: np.ndarray, grams: np.ndarray, text: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every gram, the index of the smallest among it and the next ``window - 1`` grams of its text (leftmost
    among equals), and whether the text has so many grams; where it has fewer in all, its first gram counts as whole.

    ``at`` are the start words of ``grams``, ``text`` the text of every word.
    """
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    bounds = np.flatnonzero(np.diff(text[at], prepend=-1))
    lengths = np.diff(np.append(bounds, len(at)))
    last, size = np.repeat(bounds + lengths - 1, lengths), np.repeat(lengths, lengths)
    best, width = np.arange(len(at)), 1
    while width < window:  # best covers `width` grams; two overlapping spans cover more
        step = min(width, window - width)
        ahead = best[np.minimum(np.arange(len(at)) + step, last)]
        best = np.where(grams[ahead] < grams[best], ahead, best)
        width += step
    local = np.arange(len(at)) - np.repeat(bounds, lengths)
    return best, local <= np.maximum(size - window, 0)


def distinct(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, by owner and value."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(owner: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """Values grouped by their owner 0..n-1; owners are in ascending order."""
    offsets = np.searchsorted(owner, np.arange(n + 1), "left").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))

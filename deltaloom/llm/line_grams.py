"""Candidate pairs of lines by MinHash bands over character grams of their normal forms.

A gram is 5 bytes of the normal form, spaces included: an edit touches at most 5 of them, so lines of edit similarity 0.9
share most of theirs wherever the edits are. Of each line BANDS times ROWS minima are taken; lines that agree in
all minima of a band meet. Whatever meets in a band is a run. Identical runs of several bands count once. The runs are small
beside the lines, are materialised, and give the pairs to verify: first each member with the one of middle length, then,
within the runs that do not hang together by verified pairs, every pair across different components.
Pairs whose lengths alone rule the similarity out are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from . import kernels as K
from . import packing as P

GRAM, ROWS, BANDS = 5, 4, 24
MIN_CHARS = 20
KEY_BYTES = 5
#: Lengths travel as a byte, in steps of 5 %; see `steps`.
STEP = np.log(1.05)
PIECE = 1 << 16
_FACTORS = (K.mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_BYTES = (K.mix(np.arange(257, 513, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def normal_lines(c: K.Chunk) -> tuple[np.ndarray, ...]:
    """row, line number and words of each line that has words; the normal forms' bytes back to back, with starts and ends."""
    newlines = np.flatnonzero(c.data == 10)
    start, end = np.sort(np.concatenate([c.offsets[:-1], newlines + 1])), np.sort(np.concatenate([newlines, c.offsets[1:]]))
    ws, we = K.spans(c.data, c.offsets, K.WORD_CHAR)
    at, to = np.searchsorted(ws, start), np.searchsorted(ws, end)
    on = to > at
    start, at, to = start[on], at[on], to[on]
    row = np.searchsorted(c.offsets, start, "right") - 1
    number = np.searchsorted(newlines, start) - np.searchsorted(newlines, c.offsets[row])
    keep, text = K.WORD_CHAR[c.data], K.LOWER_DIGITLESS[c.data]
    later = np.ones(len(ws), bool)
    later[at] = False
    gap = ws[later] - 1
    keep[gap], text[gap] = True, 32
    place = np.concatenate([[0], np.cumsum(we - ws + later)])  # of the normal forms' bytes, up to each word
    return row, number, to - at, text[keep], place[at], place[to]


def characters(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    later = np.flatnonzero(text & 0xC0 == 0x80)  # bytes of a character behind its first
    return end - start - (np.searchsorted(later, end) - np.searchsorted(later, start))


def length_step(chars: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.log(np.maximum(chars, 1)) / STEP).astype(np.uint8)


def bands(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """BANDS keys of each line of at least GRAM bytes: an array (BANDS, lines)."""
    x = np.zeros(len(text) - GRAM + 1, np.uint32)
    for i in range(GRAM):
        x = x * np.uint32(0x9E3779B1) + _BYTES[text[i : i + len(x)]]
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x = (x ^ x >> np.uint32(shift)) * np.uint32(factor)
    x ^= x >> np.uint32(16)
    count = end - start - GRAM + 1
    to = np.cumsum(count)
    least = np.empty((len(_FACTORS), len(start)), np.uint32)
    edge = np.unique(np.append(np.searchsorted(to, np.arange(0, to[-1], PIECE), "right"), len(start)))
    for a, b in zip(np.append(0, edge[:-1]) if edge[0] else edge[:-1], edge if edge[0] else edge[1:]):
        at = to[a:b] - count[a:b] - (to[a] - count[a])
        part = x[np.repeat(start[a:b] - at, count[a:b]) + np.arange(count[a:b].sum())]
        for j, f in enumerate(_FACTORS):
            least[j, a:b] = np.minimum.reduceat(part * f, at)
    out = np.repeat(np.arange(BANDS, dtype=np.uint64)[:, None], len(start), axis=1)
    for i in range(ROWS):
        out = K.mix(out << np.uint64(32) ^ out >> np.uint64(32) ^ least[i::ROWS])
    return out


def enough(words: np.ndarray, chars: np.ndarray, min_words: int) -> np.ndarray:
    """Whether lines are long enough to be similar to others: by words, or by characters where words are not spaced."""
    return (words >= min_words) | (chars >= MIN_CHARS)


def scatter(parts: int, min_words: int):
    """Rows (id, rid, text) to packed band keys with their lines' keys and lengths; a line counts once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for c in K.chunks(batch.column(2)):
                _, _, words, text, start, end = normal_lines(c)
                chars = characters(text, start, end)
                on = enough(words, chars, min_words) & (end - start >= GRAM)
                h = K.hash_ranges(text, start, end)
                for i in np.flatnonzero(on):
                    on[i] = (x := int(h[i])) not in seen
                    seen.add(x)
                if not on.any():
                    continue
                start, end, h = start[on], end[on], h[on]
                size = length_step(chars[on])
                key = bands(text, start, end).ravel()
                part = P.part_of(key, parts)
                order = np.argsort(part, kind="stable")
                there, at = np.unique(part[order], return_index=True)
                pieces = np.split(order, at[1:])
                yield pa.record_batch([pa.array(there.astype(np.int32)), *[pa.array([x[p].tobytes() for p in pieces], pa.binary()) for x in (key.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES], np.tile(h, BANDS), np.tile(size, BANDS))]], names=["part", "key", "h", "size"])

    return run


SCATTERED = "part int, key binary, h binary, size binary"
RUNS = "run long, h array<long>, size array<int>"


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of two and more lines that share a band's key, by length."""
    got = list(batches)
    if not got:
        return
    key, h, size = (np.frombuffer(b"".join(x.as_py() for b in got for x in b.column(n)), kind) for n, kind in (("key", np.uint8), ("h", np.uint64), ("size", np.uint8)))
    del got
    whole = np.zeros((len(h), 8), np.uint8)
    whole[:, :KEY_BYTES] = key.reshape(-1, KEY_BYTES)
    key = whole.view(np.uint64).ravel()
    order = np.lexsort((h, size, key))
    key, h, size = key[order], h[order], size[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (h[1:] != h[:-1])])
    key, h, size = key[new], h[new], size[new]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(np.append(at, len(key)))
    run = K.mix(np.add.reduceat(K.mix(h), at))
    _, first = np.unique(run, return_index=True)
    first = np.sort(first[n[first] > 1])
    for a in range(0, len(first), 10_000):
        f = first[a : a + 10_000]
        offsets = np.concatenate([[0], np.cumsum(n[f])])
        index = np.repeat(at[f] - offsets[:-1], n[f]) + np.arange(offsets[-1])
        yield pa.record_batch([pa.array(run[f].view(np.int64)), _lists(offsets, h[index].view(np.int64)), _lists(offsets, size[index].astype(np.int32))], names=["run", "h", "size"])


def steps(similarity: float) -> int:
    return int(-np.log(similarity) / STEP) + 1


def _may(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether lengths in steps leave the similarity possible: never false where it is."""
    return np.abs(x - y) <= steps(similarity)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def stars(similarity: float):
    """Each member of a run with the one of middle length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, size = (batch.column(i).flatten().to_numpy() for i in (1, 2))
            n = batch.column(1).value_lengths().to_numpy()
            centre = np.repeat(np.cumsum(n) - n + n // 2, n)
            on = (h != h[centre]) & _may(size, size[centre], similarity)
            yield _pairs(h[centre][on], h[on])

    return run


def across(similarity: float):
    """Rows (members) of runs, as arrays of (size, h, label), to all pairs of different labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column(0):
                size, h, label = (x.to_numpy() for x in members.values.flatten())
                order = np.lexsort((h, size))
                size, h, label = size[order], h[order], label[order]
                to = np.searchsorted(size, size + steps(similarity), "right")
                a, b, held = [], [], 0
                for i in range(len(h)):
                    j = np.arange(i + 1, to[i])
                    j = j[(label[j] != label[i]) & _may(size[j], size[i], similarity)]
                    a.append(np.full(len(j), h[i]))
                    b.append(h[j])
                    held += len(j)
                    if held > 1 << 20 or i == len(h) - 1:
                        yield _pairs(np.concatenate(a), np.concatenate(b))
                        a, b, held = [], [], 0

    return run

"""Vectorised text kernels over Arrow buffers.

A column of texts is seen as one array of UTF-8 bytes with offsets, so words, lines and shingles of thousands of
documents are found and hashed by a few numpy passes instead of a Python loop over words. Everything works in
bounded pieces: the extra memory follows `PIECE`, not the length of a text.

Hashes are 64 bits: sums of a random value per byte times powers of an odd multiplier, finished by a bit mixer.
They are pure functions of the bytes, alike on every machine.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_M64 = (1 << 64) - 1


def give_back() -> None:
    """Free memory of this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def released(run):
    """The function of a task's batches; when they end, what the process holds of free memory goes back to the system.

    Workers are used again and again, and a machine's limit counts all that they hold.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all input bits over all output bits (an invertible 64-bit finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_R = 0xD6E8FEB86659FD93
_RINV = pow(_R, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _tables or len(_tables["up"]) < n:
        _tables["up"], _tables["down"] = _powers(_R, n), _powers(_RINV, n)
    return _tables["up"], _tables["down"]


def byte_table(keep) -> np.ndarray:
    return np.array([bool(keep(b)) for b in range(256)])


#: Bytes of words that end at ASCII white space only.
NOT_SPACE = byte_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Bytes of words made of ASCII letters, digits and everything beyond ASCII.
WORD_CHAR = byte_table(lambda b: chr(b).isalnum() if b < 128 else True)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
LOWER_DIGITLESS = np.array([48 if 48 <= b <= 57 else LOWER[b] for b in range(256)], np.uint8)


class Chunk(NamedTuple):
    """Rows first..first+len(offsets)-1 of a batch: their bytes back to back, with offsets."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


def chunks(column: pa.Array, size: int = 2 * PIECE) -> Iterator[Chunk]:
    """Whole texts in runs of about `size` bytes; nulls count as empty."""
    if pa.types.is_string(column.type):
        kind = np.int32
    elif pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.large_string()), np.int64
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, off, buf = column.buffers()
    off = np.frombuffer(off, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        b = min(b, n, a + 60_000)
        yield Chunk(a, data[off[a] : off[b]], off[a : b + 1] - off[a])
        a = b


class Words(NamedTuple):
    """Words of a chunk: byte ranges, hashes, and where each text's words begin and end."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bound: np.ndarray


def spans(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of kept bytes that do not cross an offset."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    on = keep[data]
    edge = np.empty(n + 1, bool)
    edge[0], edge[n] = on[0], on[-1]
    np.not_equal(on[1:], on[:-1], out=edge[1:-1])
    inner = offsets[(offsets > 0) & (offsets < n)]
    inner = inner[on[inner] & on[inner - 1]]
    at = np.flatnonzero(edge)
    if len(inner):
        inner = np.unique(inner)
        at = np.sort(np.concatenate([at, inner, inner]))
    return at[0::2], at[1::2]


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """Hash of data[start:end] for ascending, disjoint ranges."""
    return hash_prefixes(data, starts, ends, (), fold)[0]


def hash_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lengths: tuple[int, ...], fold: np.ndarray = LOWER) -> list[np.ndarray]:
    """Hashes of data[start:end], then of each range's first bytes for every length."""
    out = [np.empty(len(starts), np.uint64) for _ in range(1 + len(lengths))]
    values = _BYTE[fold]
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        piece = data[base : ends[j - 1]]
        up, down = _power_tables(max(PIECE, len(piece)) + 1)
        total = np.empty(len(piece) + 1, np.uint64)
        total[0] = 0
        np.cumsum(values[piece] * up[: len(piece)], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        low, scale = total[s], down[s]
        out[0][i:j] = (total[e] - low) * scale
        for x, n in zip(out[1:], lengths):
            x[i:j] = (total[np.minimum(e, s + n)] - low) * scale
        i = j
    return [mix(x) for x in out]


def words(chunk: Chunk, keep: np.ndarray = NOT_SPACE, fold: np.ndarray = LOWER) -> Words:
    s, e = spans(chunk.data, chunk.offsets, keep)
    return Words(s, e, hash_ranges(chunk.data, s, e, fold), np.searchsorted(s, chunk.offsets))


def _place(k: int) -> list[np.uint64]:
    return [np.uint64(pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64)) for i in range(k)]


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's k-word runs in order (repeats kept), and their bounds per text.

    A text of 1 to k-1 words has its whole sequence as its only shingle; one without words has none.
    """
    n, h, bound = len(w.hash), w.hash, w.bound
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(bound), np.int64)
    place = _place(k)
    value = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        value[: n - j] += h[j:] * place[j]
    on = np.ones(n, bool)
    size = np.diff(bound)
    for j in range(1, k):
        on[(bound[1:] - j)[size >= j]] = False
    for i in np.flatnonzero((size > 0) & (size < k)):
        a, b = bound[i], bound[i + 1]
        on[a] = True
        value[a] = np.uint64(sum(int(x) * int(p) for x, p in zip(h[a:b], place)) + int(b - a) & _M64)
    total = np.concatenate([[0], np.cumsum(on)])
    return mix(value[on]), total[bound]


def per_text(values: np.ndarray, bound: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row in the chunk, sorted distinct values) of each text that has any."""
    for i in np.flatnonzero(np.diff(bound)):
        x = np.sort(values[bound[i] : bound[i + 1]])
        if len(x) > 1:
            x = x[np.concatenate([[True], x[1:] != x[:-1]])]
        yield int(i), x

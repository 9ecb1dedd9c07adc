"""Edit similarity of many pairs of texts at once.

For each number of edits the furthest point on every diagonal of every pair is kept and run on over equal characters,
so the work grows with the square of the distance, hardly with the texts' length. Pairs are taken in batches of like limits;
numpy handles all diagonals of a batch in one step. Characters are code points.

Before that, an exact bound drops pairs of long texts that can't be near: an edit changes at most GRAM of a text's
GRAM-grams, so those of one text that the other lacks are at most GRAM times the distance. Grams are counted in hashed
buckets, which only lowers that count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import kernels as K

GRAM = 6
#: Pairs of higher limits are held against the bound first; below, the distance itself costs less.
BOUND_FROM = 100
CELLS = 1 << 19
PIECE = 1 << 20
_B = 0x9E3779B97F4A7C15
_FAR = np.int32(-(1 << 30))
#: Jumps over equal characters, by hashes of so many.
JUMPS = (64, 8)


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All characters back to back as code points, and each text's bounds."""
    column = column.cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and off[-1] > off[0] else np.empty(0, np.uint8)
    total = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])
    return np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32), total[off - off[0]]


def _spaced(chars: np.ndarray, bound: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts with an end mark behind each and a margin behind all; where each begins."""
    n = np.diff(bound)
    start = bound[:-1] + np.arange(len(n))
    out = np.full(len(chars) + len(n) + max(JUMPS), end, np.uint64)
    out[np.arange(len(chars)) + np.repeat(np.arange(len(n)), n)] = chars
    return out, start


def _hashes(x: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the next 8 and 64 values at each place, by doubling."""
    out, h, w, b = {}, K.mix(x), 1, _B
    while w < max(JUMPS):
        nxt = h.copy()
        nxt[: len(h) - w] += h[w:] * np.uint64(b)
        h, w, b = nxt, 2 * w, b * b & K._M64
        if w in JUMPS:
            out[w] = h
    return out


def _grams(x: np.ndarray) -> np.ndarray:
    h = np.zeros(len(x), np.uint64)
    for i in range(GRAM):
        h[: len(x) - i] += x[i:] * np.uint64(pow(_B, i + 1, 1 << 64))
    return K.mix(h)


def _grams_apart(a: np.ndarray, sa: np.ndarray, n: np.ndarray, b: np.ndarray, sb: np.ndarray, m: np.ndarray) -> np.ndarray:
    """For each pair a lower bound of the grams of one text that the other lacks. a, b: the grams at each place."""
    size = 8 * np.maximum(np.maximum(n, m), 1)
    first = np.concatenate([[0], np.cumsum(size)])
    counts = np.zeros(first[-1], np.int32)
    for x, start, length, sign in ((a, sa, n, 1), (b, sb, m, -1)):
        grams = np.maximum(length - GRAM + 1, 0)
        pair = np.repeat(np.arange(len(n)), grams)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(grams) - grams, grams) + np.repeat(start, grams)
        slot = first[pair] + (x[at] % size[pair].astype(np.uint64)).astype(np.int64)
        counts += sign * np.bincount(slot, minlength=len(counts)).astype(np.int32)
    more = np.add.reduceat(np.maximum(counts, 0), first[:-1])
    less = np.add.reduceat(np.maximum(-counts, 0), first[:-1])
    return np.maximum(more, less)


def _batch(a: np.ndarray, b: np.ndarray, ha: dict, hb: dict, sa: np.ndarray, n: np.ndarray, sb: np.ndarray, m: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Distances of pairs, or -1 beyond their limits."""
    out = np.full(len(n), -1, np.int64)
    width = int(limit.max()) + 1
    k = np.arange(-width, width + 1, dtype=np.int32)
    alive, delta = np.arange(len(n)), (m - n).astype(np.int32)
    cap = np.minimum(n[:, None], m[:, None] - k).astype(np.int32)  # a diagonal's last point
    least = np.maximum(0, -k)  # and its first
    far = np.full(cap.shape, _FAR, np.int32)
    far[:, width] = -1  # so that the first step starts at 0
    room = limit.astype(np.int32)  # edits that are left
    for d in range(width):
        # diagonals that can be reached and from which some pair can still end in time
        lo = width + max(-d, int((delta - room).min()))
        hi = width + min(d, int((delta + room).max())) + 1
        best = np.maximum(far[:, lo:hi], far[:, lo + 1 : hi + 1]) + 1 if d else far[:, lo:hi] + 1
        if d:
            np.maximum(best, far[:, lo - 1 : hi - 1], out=best)
        np.minimum(best, cap[:, lo:hi], out=best)
        open_ = best >= least[lo:hi]
        best[~open_] = _FAR
        flat = np.flatnonzero(open_)
        row, col = np.divmod(flat, hi - lo)
        i = best.ravel()[flat]
        x, y = sa[row] + i, sb[row] + i + k[lo:hi][col]
        on = np.flatnonzero(a[x] == b[y])
        if len(on):
            gone, at, steps = np.zeros(len(flat), np.int32), on, 0
            while len(at):
                gone[at] += 1
                steps += 1
                if steps % 4 == 0:  # what still runs is likely a long way of equal characters
                    for w in JUMPS:
                        j = at
                        while len(j := j[ha[w][x[j] + gone[j]] == hb[w][y[j] + gone[j]]]):
                            gone[j] += w
                at = at[a[x[at] + gone[at]] == b[y[at] + gone[at]]]
            best.ravel()[flat[on]] = i[on] + gone[on]
        far[:, lo:hi] = best
        there = np.flatnonzero((delta >= lo - width) & (delta < hi - width))
        done = there[best[there, delta[there] + width - lo] >= n[there]]
        out[alive[done]] = d
        room -= 1
        left = room >= 0
        left[done] = False
        if not left.any():
            break
        if left.sum() < 0.8 * len(left):
            far, cap, alive, delta, room, sa, n, sb = (v[left] for v in (far, cap, alive, delta, room, sa, n, sb))
        elif not left.all():  # the finished stay along until it pays to drop them
            far[~left] = _FAR
            room[~left] = 0
            delta[~left] = 0
    return np.where(out <= limit, out, -1)


def distances(ta: pa.Array, tb: pa.Array, similarity: float) -> np.ndarray:
    """Edit distance of each pair whose similarity 1 - distance / longer length is at least `similarity`, else -1.

    Pairs are taken PIECE bytes of text at a time, or one, so memory follows that or the longest pair; those of like lengths
    together, as they have like limits.
    """
    out = np.empty(len(ta), np.int64)
    n, m = (pc.binary_length(t).to_numpy(zero_copy_only=False).astype(np.int64) for t in (ta, tb))
    for rows in _pieces(np.argsort(np.maximum(n, m), kind="stable"), n + m, PIECE):
        at = pa.array(rows)
        out[rows] = _distances(ta.take(at), tb.take(at), similarity)
    return out


def _distances(ta: pa.Array, tb: pa.Array, similarity: float) -> np.ndarray:
    (ca, ba), (cb, bb) = code_points(ta), code_points(tb)
    n, m = np.diff(ba), np.diff(bb)
    limit = np.floor(np.maximum(n, m) * (1 - similarity) + 1e-9).astype(np.int64)
    out = np.full(len(n), -1, np.int64)
    (a, sa), (b, sb) = _spaced(ca, ba, 0xFFFFFFFF), _spaced(cb, bb, 0xFFFFFFFE)
    may = np.abs(n - m) <= limit
    if len(long := np.flatnonzero(may & (limit > BOUND_FROM))):
        ga, gb = _grams(a), _grams(b)
        for part in _pieces(long, 16 * (n + m), CELLS * 4):
            may[part] = _grams_apart(ga, sa[part], n[part], gb, sb[part], m[part]) <= GRAM * limit[part]
    may = np.flatnonzero(may)
    if len(may):
        ha, hb = _hashes(a), _hashes(b)
        may = may[np.argsort(limit[may], kind="stable")]
        for part in _pieces(may, 2 * limit + 3, CELLS, like=limit):
            out[part] = _batch(a, b, ha, hb, sa[part], n[part], sb[part], m[part], limit[part])
    return out


def _pieces(rows: np.ndarray, weight: np.ndarray, most: int, like: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Runs of rows of bounded total weight; with `like`, also of values of which the last is at most 1.5 times the first, and 8."""
    i = 0
    while i < len(rows):
        total = np.cumsum(weight[rows[i : i + 65_536]])
        j = i + max(1, int(np.searchsorted(total, most, "right")))
        if like is not None:
            j = min(j, max(i + 1, i + int(np.searchsorted(like[rows[i:j]], 1.5 * like[rows[i]] + 8, "right"))))
        yield rows[i:j]
        i = j

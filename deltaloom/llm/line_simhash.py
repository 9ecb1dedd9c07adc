"""SimHashes of lines, and the join of those that are near on pigeonhole blocks.

Features of a line are the distinct words of its normal form, by their first 8 bytes, and of words of more than LONG_WORD
bytes, as scripts without spaces have them, the runs of GRAM bytes too. 64 bits of the SimHash are cut into BLOCKS; two lines meet if
they agree in SHARED of them, which those of at most BLOCKS - SHARED differing bits always do, and are candidates if then
at most DISTANCE of the 64 bits differ. 24 further bits and the length are a second look, which keeps what agrees by chance from
being compared: at most TOTAL of all 88 bits may differ, TOTAL_SHORT in short lines, and lengths that rule the similarity
out never pass.

Of any three blocks two are in the same half of them, so a SimHash is sent to one partition for each pair of blocks of
a half only, and all third blocks are looked through where it arrives, in order of length, so that lengths too far apart are
never compared. What is left to compare grows with the square of the lines over 2 to the bits of SHARED blocks (19): fine
up to some 10^9 distinct lines; beyond, more blocks and SHARED = 4 are the setting.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import kernels as K
from . import packing as P
from .edits import _pieces
from .line_grams import characters

GRAM, LONG_WORD, BUCKETS = 6, 16, 14
BLOCKS, SHARED, DISTANCE, TOTAL = 10, 3, 13, 14
#: Lines of up to so many characters have few words, of which each moves more bits.
SHORT, TOTAL_SHORT = 200, 17
MANY = 256
PIECE, PAIRS_AT_ONCE = 1 << 17, 1 << 20
#: Lengths travel as a byte, in steps of 4 %.
STEP = np.log(1.04)


def _bits(a: int, b: int) -> np.uint64:
    return np.uint64(((1 << b) - 1) ^ ((1 << a) - 1))


_EDGES = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
_WIDEST = max(b - a for a, b in zip(_EDGES, _EDGES[1:]))
MASKS = [_bits(a, b) for a, b in zip(_EDGES, _EDGES[1:])]
_HALF = BLOCKS // 2
#: A SimHash goes by these pairs of blocks.
ROUTES = [(i, j) for i, j in combinations(range(BLOCKS), 2) if (i < _HALF) == (j < _HALF)]
#: The third blocks that each route looks through; so every three blocks have their turn once.
THIRDS = [[k for k in range(BLOCKS) if k not in (i, j) and (k > j or (k < _HALF) != (i < _HALF))] for i, j in ROUTES]


assert max(map(len, THIRDS)) <= 1 << 24 - 3 * _WIDEST  # a third's number, three blocks and a length fit in 32 bits


def _first_routes() -> np.ndarray:
    """For each set of blocks in which a pair agrees, as bits, the first route by which it meets; -1 if by none."""
    out = np.full(1 << BLOCKS, -1, np.int8)
    for bits in range(1 << BLOCKS):
        for r, (i, j) in enumerate(ROUTES):
            if bits >> i & 1 and bits >> j & 1 and any(bits >> k & 1 for k in THIRDS[r]):
                out[bits] = r
                break
    return out


_FIRST = _first_routes()


def first_route(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    z, bits = s ^ t, np.zeros(len(s), np.int64)
    for k, mask in enumerate(MASKS):
        bits |= ((z & mask) == 0).astype(np.int64) << k
    return _FIRST[bits]


def _lanes() -> np.ndarray:
    """For each bucket 88 bits of 0 or 1, a byte each, in 11 machine words: sums of up to 255 need no carry."""
    n = 1 << BUCKETS
    x = np.stack([K.mix(np.arange(n, dtype=np.uint64) + np.uint64(i * n + 1)) for i in (1, 2)], axis=1)
    return np.ascontiguousarray(np.unpackbits(x.view(np.uint8).reshape(n, 16), axis=1)[:, :88]).view(np.uint64)


_LANES = _lanes()


_KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def _eight(text: np.ndarray) -> np.ndarray:
    """At each place the next 8 bytes as one number, the first lowest; zeros follow the text."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray(len(text), "<u8", padded, strides=(1,))


def _bucket(x: np.ndarray) -> np.ndarray:
    return (K.mix(x) >> np.uint64(64 - BUCKETS)).astype(np.uint32)


def _features(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """line << BUCKETS | bucket of the distinct features of some lines, in order."""
    base = int(start[0])
    text, start, end = text[base : int(end[-1])], (start - base).astype(np.int32), (end - base).astype(np.int32)
    wide = np.uint32 if len(start) < 1 << 32 - BUCKETS else np.uint64
    begin = np.sort(np.concatenate([start, np.flatnonzero(text == 32).astype(np.int32) + 1]))
    of = (np.searchsorted(start, begin, "right") - 1).astype(np.int32)
    inside = begin < end[of]  # what lies between the lines asked for is not
    begin, of = begin[inside], of[inside]
    stop = end[of]
    stop[:-1] = np.where(of[1:] == of[:-1], begin[1:] - 1, stop[:-1])
    length = stop - begin
    eight = _eight(text)
    key = of.astype(wide) << wide(BUCKETS) | _bucket((eight[begin] & _KEEP[np.minimum(length, 8)]) + np.uint64(1))
    if len(long := np.flatnonzero(length > LONG_WORD)):
        runs = length[long] - GRAM + 1
        at = np.arange(runs.sum()) + np.repeat(begin[long] - (np.cumsum(runs) - runs), runs)
        key = np.concatenate([key, np.repeat(of[long], runs).astype(wide) << wide(BUCKETS) | _bucket(eight[at] & _KEEP[GRAM] ^ np.uint64(1 << 63))])
    key = np.sort(key)
    return key[np.concatenate([[True], key[1:] != key[:-1]])]


def simhashes(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64 bits of each line, and the further 24 with the length; text: the lines' normal forms."""
    s, x = np.empty(len(start), np.uint64), np.empty(len(start), np.int32)
    step = np.minimum(255, np.log(np.maximum(characters(text, start, end), 1)) / STEP).astype(np.int32)
    total = np.cumsum(end - start)
    edge = np.unique(np.append(np.searchsorted(total, np.arange(0, total[-1] if len(total) else 0, PIECE), "right"), len(start)))
    for a, b in zip(np.append(0, edge[:-1]) if len(edge) and edge[0] else edge[:-1], edge if len(edge) and edge[0] else edge[1:]):
        key = _features(text, start[a:b], end[a:b])
        at = np.searchsorted(key, np.arange(b - a, dtype=key.dtype) << key.dtype.type(BUCKETS))
        n = np.diff(np.append(at, len(key)))
        parts = -(-n // 255)
        cut = np.repeat(at, parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        sums = np.add.reduceat(np.take(_LANES, key & key.dtype.type((1 << BUCKETS) - 1), axis=0), cut, axis=0)
        ones = np.add.reduceat(sums.view(np.uint8).reshape(len(sums), -1), np.cumsum(parts) - parts, axis=0, dtype=np.int32)
        out = np.packbits(2 * ones > n[:, None], axis=1)
        s[a:b] = np.ascontiguousarray(out[:, :8]).view(np.uint64).ravel()
        x[a:b] = out[:, 8].astype(np.int32) << 24 | out[:, 9].astype(np.int32) << 16 | out[:, 10].astype(np.int32) << 8 | step[a:b]
    return s, x


def length_steps(similarity: float) -> int:
    return int(-np.log(max(similarity, 1e-9)) / STEP) + 1


def close(s: np.ndarray, t: np.ndarray, x: np.ndarray, y: np.ndarray, steps: int) -> np.ndarray:
    """Whether SimHashes s, t with further bits and lengths x, y are near."""
    d, z, m, n = np.bitwise_count(s ^ t), x ^ y, x & 255, y & 255
    most = np.where(np.minimum(m, n) <= int(np.log(SHORT) / STEP), np.uint8(TOTAL_SHORT), np.uint8(TOTAL))
    return (d <= DISTANCE) & (d + np.bitwise_count(z.view(np.uint32) >> np.uint32(8)) <= most) & (np.abs(m - n) <= steps)


def _part(s: np.ndarray, route: int, parts: int) -> np.ndarray:
    i, j = ROUTES[route]
    return P.part_of(K.mix((s & (MASKS[i] | MASKS[j])) ^ np.uint64(route)), parts)


def scatter(parts: int):
    """Rows (s, x) to packed rows by partition; with a third column, a label, that travels along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1 << 15):
                b = batch.slice(a, 1 << 15)
                s, x, n = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy(), b.num_rows
                part = np.concatenate([_part(s, r, parts) for r in range(len(ROUTES))])
                if b.num_columns == 2:
                    owner, owners, route = np.repeat(np.arange(len(ROUTES)), n), np.zeros(len(ROUTES), np.int64), np.arange(len(ROUTES), dtype=np.int32)
                else:
                    owner, owners = np.arange(n * len(ROUTES)), np.tile(b.column(2).to_numpy(), len(ROUTES))
                    route = np.repeat(np.arange(len(ROUTES), dtype=np.int32), n)
                yield from P.pack(part, owner, owners, route, np.tile(s, len(ROUTES)), np.tile(x, len(ROUTES)))

    return run


def _apart(label: np.ndarray | None, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs of different labels; MANY_LABELS, of SimHashes whose lines have several, differs from itself too."""
    if label is None:
        return np.ones(len(a), bool)
    return (label[a] != label[b]) | (label[a] == MANY_LABELS)


MANY_LABELS = -1


def _large(s: np.ndarray, x: np.ndarray, at: np.ndarray, steps: int, label: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A large group: what its centre is near to hangs together by that, and all else is compared with everything.

    With labels, what has the commonest one hangs together already.
    """
    if label is None:
        some = at[np.linspace(0, len(at) - 1, 16).astype(int)]
        hits = [close(s[at], s[c], x[at], x[c], steps) for c in some]
        best = int(np.argmax([h.sum() for h in hits]))
        centre, hit = some[best], hits[best]
        yield at[hit], np.full(hit.sum(), centre)
        rest = at[~hit]
    else:
        kinds, n = np.unique(label[at][label[at] != MANY_LABELS], return_counts=True)
        rest = at[label[at] != kinds[np.argmax(n)]] if len(kinds) else at
    for c in rest:
        hit = at[close(s[at], s[c], x[at], x[c], steps)]
        yield hit, np.full(len(hit), c)


def _packed(s: np.ndarray, blocks: tuple[int, ...]) -> np.ndarray:
    """The bits of some blocks side by side."""
    out = np.zeros(len(s), np.uint32)
    for i in blocks:
        width = _EDGES[i + 1] - _EDGES[i]
        out = out << np.uint32(width) | (s >> np.uint64(_EDGES[i]) & np.uint64((1 << width) - 1)).astype(np.uint32)
    return out


def near(s: np.ndarray, x: np.ndarray, route: int, steps: int, label: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in s that agree in the route's blocks and a third one and are near; some come repeatedly.

    Of large groups only pairs that connect them. All third blocks are gone through at once.
    """
    n, thirds = len(s), THIRDS[route]
    head, length = _packed(s, ROUTES[route]), (x & 255).astype(np.uint32)
    key = np.concatenate([(np.uint32(t << 3 * _WIDEST) | head << np.uint32(_WIDEST) | _packed(s, (k,))) << np.uint32(8) | length for t, k in enumerate(thirds)])
    whole = np.sort(key.astype(np.uint64) << np.uint64(32) | np.tile(np.arange(n, dtype=np.uint64), len(thirds)))
    order, whole = (whole & np.uint64(0xFFFFFFFF)).astype(np.int32), (whole >> np.uint64(32)).astype(np.uint32)
    up_to = whole & np.uint32(0xFFFFFF00) | np.minimum((whole & np.uint32(255)) + np.uint32(steps), 255)  # the last length of its group that may be near
    sims, active, d = s[order], np.flatnonzero(whole[1:] <= up_to[:-1]), 1
    while d <= MANY and len(active):
        on = np.flatnonzero(np.bitwise_count(sims[active] ^ sims[active + d]) <= DISTANCE)
        if len(on):
            a, b = order[active[on]], order[active[on] + d]
            on = close(s[a], s[b], x[a], x[b], steps) & _apart(label, a, b)
            if on.any():
                yield a[on], b[on]
        d += 1
        active = active[: np.searchsorted(active, len(whole) - d)]
        active = active[whole[active + d] <= up_to[active]]
    if len(active):
        group = np.concatenate([[0], np.cumsum(whole[1:] >> np.uint32(8) != whole[:-1] >> np.uint32(8))])
        for g in np.unique(group[active]):
            lo, hi = np.searchsorted(group, [g, g + 1])
            for a, b in _large(s, x, order[lo:hi], steps, label):
                on = (a != b) & _apart(label, a, b)
                if on.any():
                    yield a[on], b[on]


def _chunks(pairs: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of places below n in larger pieces, each piece's smaller place first and without repeats."""
    held, size = [], 0
    for a, b in pairs:
        held.append(np.minimum(a, b).astype(np.int64) * n + np.maximum(a, b))
        size += len(a)
        if size >= PAIRS_AT_ONCE:
            x = np.unique(np.concatenate(held))
            yield x // n, x % n
            held, size = [], 0
    if held:
        x = np.unique(np.concatenate(held))
        yield x // n, x % n


def _flat(up: np.ndarray) -> np.ndarray:
    while True:
        top = up[up]
        if np.array_equal(top, up):
            return up
        up = top


def _forest(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joins pairs a, b in the flat forest `up`, larger roots to smaller ones; which of the pairs joined something."""
    used, live = [], np.flatnonzero(up[a] != up[b])
    while len(live):
        p, q = up[a[live]], up[b[live]]
        low, high = np.minimum(p, q), np.maximum(p, q)
        order = np.lexsort((low, high))
        order = order[np.concatenate([[True], high[order[1:]] != high[order[:-1]]])]
        up = up.copy()
        up[high[order]] = low[order]
        used.append(live[order])
        up = _flat(up)
        live = live[up[a[live]] != up[b[live]]]
    return up, np.concatenate(used) if used else live


def _by_distance(up: np.ndarray, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As _forest, nearer pairs first."""
    used = [np.empty(0, np.int64)]
    for k in np.unique(d):
        on = np.flatnonzero(d == k)
        up, here = _forest(up, a[on], b[on])
        used.append(on[here])
    return up, np.concatenate(used)


PAIRS = "sa long, xa int, sb long, xb int, d int"


def _batch(s: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Pairs with the smaller (s, x) first; s, x are in that order."""
    d = np.bitwise_count(s[a] ^ s[b]).astype(np.int32)
    return pa.record_batch([pa.array(s[a].view(np.int64)), pa.array(x[a]), pa.array(s[b].view(np.int64)), pa.array(x[b]), pa.array(d)], names=["sa", "xa", "sb", "xb", "d"])


def _distinct(s: np.ndarray, x: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """In the order of (s, x), each once; what comes out must not hang on the order of arrival. Last, how often each came."""
    order = np.lexsort((x, s))
    s, x = s[order], x[order]
    at = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (x[1:] != x[:-1])]))
    return s[at], x[at], *[m[order][at] for m in more], np.diff(np.append(at, len(s)))


def _arrived(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    got = list(batches)
    if not got:
        return
    label, route, s, x = P.unpack(got)
    del got
    order = np.argsort(route.astype(np.uint8), kind="stable")
    label, route, s, x = label[order], route[order], s[order], x[order]
    edge = np.searchsorted(route, np.arange(len(ROUTES) + 1))
    for r in range(len(ROUTES)):
        a, b = edge[r], edge[r + 1]
        if b - a > 1:
            yield r, label[a:b], s[a:b], x[a:b]


def meet(steps: int):
    """A spanning forest of the near SimHashes that arrive by each route; one that came twice is paired with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, _, s, x in _arrived(batches):
            s, x, times = _distinct(s, x)
            if r == 0 and (times > 1).any():
                twice = np.flatnonzero(times > 1)
                yield _batch(s, x, twice, twice)
            up = np.arange(len(s))
            for a, b in _chunks(near(s, x, r, steps), len(s)):
                up, used = _by_distance(up, a, b, np.bitwise_count(s[a] ^ s[b]))
                if len(used):
                    yield _batch(s, x, a[used], b[used])

    return run


def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of all pairs of a partition, nearer ones first; pairs of one with itself stay."""
    got = pa.Table.from_batches(list(batches), schema=ARROW_PAIRS)
    if not len(got):
        return
    sa, xa, sb, xb, d = (got.column(i).to_numpy() for i in range(5))
    sa, sb = sa.view(np.uint64), sb.view(np.uint64)
    s, x, _ = _distinct(np.concatenate([sa, sb]), np.concatenate([xa, xb]))
    place = _places(s, x, sa, xa), _places(s, x, sb, xb)
    _, used = _by_distance(np.arange(len(s)), *place, d)
    used = np.concatenate([used, np.flatnonzero(place[0] == place[1])])
    for i in range(0, len(used), 100_000):
        yield _batch(s, x, place[0][used[i : i + 100_000]], place[1][used[i : i + 100_000]])


ARROW_PAIRS = pa.schema([("sa", pa.int64()), ("xa", pa.int32()), ("sb", pa.int64()), ("xb", pa.int32()), ("d", pa.int32())])


def _places(s: np.ndarray, x: np.ndarray, t: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Where each (t, y) is in the ordered, distinct (s, x)."""
    at = np.searchsorted(s, t)
    while (off := np.flatnonzero(x[at] != y)).size:
        at[off] += 1
    return at


def meet_across(steps: int, closest: int | None = None):
    """Near pairs of different labels, each by the first of its routes: all, or for each route each one's closest ones.

    A pair counts for the line whose label has fewer lines here, or for both: few lines beside a large component don't
    come up for each of its lines. `whole` tells with each pair whether the lines it counts for have all of theirs there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, label, s, x in _arrived(batches):
            s, x, label, _ = _distinct(s, x, label)
            _, of, n = np.unique(label, return_inverse=True, return_counts=True)
            size = np.where(label == MANY_LABELS, 0, n[of])
            for a, b in _chunks(near(s, x, r, steps, label), len(s)):
                here = first_route(s[a], s[b]) == r
                a, b = a[here], b[here]
                whole = np.ones(len(a), bool)
                if closest and len(a):
                    pair = np.concatenate([np.flatnonzero(size[a] <= size[b]), np.flatnonzero(size[b] <= size[a])])
                    turn = np.arange(len(pair)) >= np.count_nonzero(size[a] <= size[b])
                    one, other = np.where(turn, b[pair], a[pair]), np.where(turn, a[pair], b[pair])
                    d = np.bitwise_count(s[one] ^ s[other])
                    order = np.lexsort((K.mix(s[other]), d, one))
                    first = np.flatnonzero(np.concatenate([[True], one[order[1:]] != one[order[:-1]]]))
                    count = np.diff(np.append(first, len(order)))
                    rank = np.arange(len(order)) - np.repeat(first, count)
                    all_there = np.ones(len(s), bool)
                    all_there[one[order[first]]] = count <= closest
                    keep = np.unique(pair[order[rank < closest]])
                    a, b = a[keep], b[keep]
                    whole = all_there[a] & all_there[b]  # one that nothing counts for lacks nothing
                pairs = _batch(s, x, a, b)
                yield pa.RecordBatch.from_arrays([*pairs.columns, pa.array(whole)], names=[*pairs.schema.names, "whole"])

    return run


TEXTS = pa.schema([("route", pa.int32()), ("s", pa.int64()), ("x", pa.int32()), ("label", pa.int64()), ("h", pa.int64()), ("t", pa.string()), ("failed", pa.list_(pa.int64()))])
LINES_AT_ONCE, CHECKED_AT_ONCE, BYTES_AT_ONCE = 1 << 12, 1 << 14, 1 << 23


def scatter_texts(parts: int):
    """Rows (s, x, label, h, t), and failed if they have it, to one message for each partition, with the route of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, LINES_AT_ONCE):
                b = batch.slice(a, LINES_AT_ONCE)
                s, n = b.column(0).to_numpy().view(np.uint64), b.num_rows
                part = np.concatenate([_part(s, r, parts) for r in range(len(ROUTES))]).astype(np.int32)
                order = np.argsort(part, kind="stable")
                lines = b.take(pa.array(order % n)).columns
                if len(lines) < len(TEXTS) - 1:
                    lines.append(pa.nulls(len(order), TEXTS.field("failed").type))
                every = pa.RecordBatch.from_arrays([pa.array((order // n).astype(np.int32)), *[c.cast(f.type) for c, f in zip(lines, list(TEXTS)[1:])]], schema=TEXTS)
                at = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1]]))
                packed = [every.slice(i, k).serialize().to_pybytes() for i, k in zip(at.tolist(), np.diff(np.append(at, len(order))).tolist())]
                yield pa.record_batch([pa.array(part[order][at]), pa.array(packed, pa.binary())], names=["part", "m"])

    return run


def _over_routes(s: np.ndarray, x: np.ndarray, edge: np.ndarray, steps: int, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs of places of all routes, each by its first route, in large pieces. edge: where each route's places begin."""
    held, size = [], 0
    for r, (i, j) in enumerate(zip(edge, edge[1:])):
        for a, b in _chunks(near(s[i:j], x[i:j], r, steps, label[i:j]), j - i) if j - i > 1 else ():
            here = first_route(s[i:j][a], s[i:j][b]) == r
            held.append((a[here] + i, b[here] + i))
            size += len(held[-1][0])
            if size >= PAIRS_AT_ONCE:
                yield tuple(np.concatenate(c) for c in zip(*held))
                held, size = [], 0
    if size:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _pairs_of(h: np.ndarray, others: pa.ChunkedArray):
    """Whether pairs of keys are among those of some lines h and their lists of others, either way round."""
    n = pc.fill_null(pc.list_value_length(others), 0).to_numpy()
    one, other = np.repeat(h, n), pc.list_flatten(others).to_numpy()
    known = np.unique(np.concatenate([one, other]))

    def places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(known, np.minimum(a, b)) * (len(known) + 1) + np.searchsorted(known, np.maximum(a, b))

    pairs = np.unique(places(one, other))

    def among(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.isin(a, known) & np.isin(b, known) & np.isin(places(a, b), pairs)

    return among


def verify_across(steps: int, near_enough):
    """Links a, b that hold between lines of different labels, all near pairs being tried where they meet, each by its first route.

    The pairs of all routes are tried together, so that they are many at once; those that failed before, which a line has with
    it, are not. What a link has joined is not tried again; pairs that fail leave no rows. near_enough: whether texts are, pair by pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [pa.ipc.read_record_batch(m.as_buffer(), TEXTS) for b in batches for m in b.column(1)]
        if not got:
            return
        every = pa.Table.from_batches(got).sort_by([("route", "ascending"), ("s", "ascending"), ("x", "ascending"), ("h", "ascending")])
        del got
        edge = np.searchsorted(every.column("route").to_numpy(), np.arange(len(ROUTES) + 1))
        s, x, h = every.column("s").to_numpy().view(np.uint64), every.column("x").to_numpy(), every.column("h").to_numpy()
        text, label = every.column("t"), np.unique(every.column("label").to_numpy(), return_inverse=True)[1]
        size, up = pc.binary_length(text).to_numpy().astype(np.int64), np.arange(label.max() + 1)
        failed = _pairs_of(h, every.column("failed"))
        for a, b in _over_routes(s, x, edge, steps, label):
            new = ~failed(h[a], h[b])
            a, b = a[new], b[new]
            order = np.argsort(np.bitwise_count(s[a] ^ s[b]), kind="stable")
            for i in range(0, len(order), CHECKED_AT_ONCE):
                here = order[i : i + CHECKED_AT_ONCE]
                here = here[up[label[a[here]]] != up[label[b[here]]]]
                for rows in _pieces(here, size[a] + size[b], BYTES_AT_ONCE):
                    p, q = a[rows], b[rows]
                    hold = near_enough(text.take(pa.array(p)).combine_chunks(), text.take(pa.array(q)).combine_chunks())
                    p, q = p[hold], q[hold]
                    up, used = _forest(up, label[p], label[q])
                    if len(used):
                        yield pa.record_batch([pa.array(h[p[used]]), pa.array(h[q[used]])], names=["a", "b"])

    return run

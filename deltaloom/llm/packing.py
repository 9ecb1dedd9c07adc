"""Packed shuffles: many small values travel as a few rows of byte arrays.

A task's values are grouped by the partition they go to and sent as one row per block and partition. A value costs
its own bytes plus a share of its owner's header, and rows are few. Blocks have a bounded number of values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SCHEMA = "part int, owner binary, size binary, count binary, value binary, weight binary"
ARROW = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in ("owner", "size", "count", "value", "weight")]])


def part_of(x: np.ndarray, parts: int) -> np.ndarray:
    return ((x.view(np.uint64) >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def pack(part: np.ndarray, owner: np.ndarray, owners: np.ndarray, sizes: np.ndarray, value: np.ndarray, weight: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Rows by partition. owner: each value's index, ascending, into owners (int64 keys) and sizes (int32)."""
    if not len(value):
        return
    order = np.argsort(part.astype(np.uint16), kind="stable") if part.max() < 65536 else np.argsort(part, kind="stable")
    p, o, v = part[order], owner[order], value[order]
    w = None if weight is None else weight[order]
    edge = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (o[1:] != o[:-1])]))
    counts = np.diff(np.concatenate([edge, [len(p)]])).astype(np.int32)
    own, size = owners[o[edge]], sizes[o[edge]]
    there = np.unique(p)
    value_at, edge_at = np.searchsorted(p, there), np.searchsorted(p[edge], there)
    value_to, edge_to = np.append(value_at[1:], len(p)), np.append(edge_at[1:], len(edge))
    for i in range(0, len(there), 512):
        rows = list(zip(there, value_at, value_to, edge_at, edge_to))[i : i + 512]
        yield pa.record_batch([
            pa.array([int(r[0]) for r in rows], pa.int32()),
            pa.array([own[c:d].tobytes() for _, _, _, c, d in rows], pa.binary()),
            pa.array([size[c:d].tobytes() for _, _, _, c, d in rows], pa.binary()),
            pa.array([counts[c:d].tobytes() for _, _, _, c, d in rows], pa.binary()),
            pa.array([v[a:b].tobytes() for _, a, b, _, _ in rows], pa.binary()),
            pa.array([None if w is None else w[a:b].tobytes() for _, a, b, _, _ in rows], pa.binary()),
        ], schema=ARROW)


def unpack(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    """(owner, size, value, weight or None) with one entry per value."""
    def joined(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(x.as_py() for b in batches for x in b.column(name) if x.is_valid), kind)

    counts = joined("count", np.int32)
    return (np.repeat(joined("owner", np.int64), counts), np.repeat(joined("size", np.int32), counts), joined("value", np.uint64), joined("weight", np.int32))

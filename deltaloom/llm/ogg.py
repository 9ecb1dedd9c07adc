"""Ogg media columns: page checksums, packets from lacing values, logical streams, granule timestamps.

`mux` lays packets of several logical streams out in Ogg pages, in time order; `demux` reads them back. A page whose
checksum, length or version is wrong is skipped, counted, and the packet it was part of is dropped; a gap in a
stream's page numbers drops the packet that it cuts. Bytes between pages are skipped.

The media of a text: its UTF-8 bytes, padded by spaces to a positive multiple of 192, as unsigned 8-bit mono samples
at `RATE` in one logical stream (a header packet, then packets of `PACKET` samples; granules count samples), and a
second stream with one mark a second. Equal texts give equal bytes.

Null texts count as empty; the empty text is 192 spaces. Null media columns give null results. Repeated rows give equal
results. Rows are handled one at a time, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship

RATE, PACKET, UNIT = 8000, 3840, 192
AUDIO, MARKS = 1, 2
HEAD = struct.Struct("<4sBBqIIIB")
AUDIO_ID, MARK_ID = b"\x7fPCM8\x01", b"\x7fMARK\x01"
CONTINUED, FIRST, LAST = 1, 2, 4
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def page_crc(page: bytes) -> int:
    """The 32-bit checksum of Ogg (polynomial 04C11DB7, high bit first, no inversion) by way of zlib's.

    zlib's uses the same polynomial with bits in the opposite order and inverts before and after.
    """
    x = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(x.to_bytes(4, "little").translate(_REVERSED), "big")


class Writer:
    """Pages of one logical stream. A page closes when its 255 lacing values are used, or by `flush`."""

    def __init__(self, serial: int, out: list[bytes]):
        self.serial, self.out, self.number = serial, out, 0
        self.lacing, self.body, self.granule, self.continued = bytearray(), bytearray(), -1, False

    def packet(self, data: bytes, granule: int) -> None:
        values = bytes([255]) * (len(data) // 255) + bytes([len(data) % 255])
        at = 0
        while values:
            room = 255 - len(self.lacing)
            part, values = values[:room], values[room:]
            size = sum(part)
            self.lacing += part
            self.body += data[at : at + size]
            at += size
            if not values:
                self.granule = granule
            if len(self.lacing) == 255:
                self.flush(continues=bool(values))

    def flush(self, continues: bool = False, last: bool = False) -> None:
        if not self.lacing and not last:
            return
        kind = CONTINUED * self.continued | FIRST * (self.number == 0) | LAST * last
        page = HEAD.pack(b"OggS", 0, kind, self.granule, self.serial, self.number, 0, len(self.lacing)) + self.lacing + self.body
        self.out.append(page[:22] + struct.pack("<I", page_crc(bytes(page))) + page[26:])
        self.number += 1
        self.lacing, self.body, self.granule, self.continued = bytearray(), bytearray(), -1, continues


def mux(payload: bytes) -> bytes:
    out: list[bytes] = []
    audio, marks = Writer(AUDIO, out), Writer(MARKS, out)
    audio.packet(AUDIO_ID + struct.pack("<I", RATE), 0)
    audio.flush()
    marks.packet(MARK_ID + struct.pack("<I", RATE), 0)
    marks.flush()
    second = 0
    for at in range(0, len(payload), PACKET):
        part = payload[at : at + PACKET]
        if at >= second * RATE:
            marks.packet(struct.pack("<I", second), at)
            marks.flush()
            second += 1
        audio.packet(part, at + len(part))
    marks.flush(last=True)
    audio.flush(last=True)
    return b"".join(out)


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)  # of the page on which each packet ends, at its last packet; else -1
    pages: int = 0
    lost: int = 0
    ended: bool = False
    _next: int | None = None
    _open: bytearray | None = None

    def page(self, kind: int, granule: int, number: int, lacing: bytes, body: memoryview) -> None:
        if self._next is not None and number != self._next:
            self.lost += 1
            self._open = None
        self._next = number + 1
        self.pages += 1
        self.ended = self.ended or bool(kind & LAST)
        if not kind & CONTINUED and self._open is not None:
            self.lost += 1
            self._open = None
        skip = bool(kind & CONTINUED) and self._open is None  # the rest of a packet whose beginning is lost
        at, size, done = 0, 0, 0
        for x in lacing:
            size += x
            if x < 255:
                if skip:
                    skip = False
                else:
                    self.packets.append(bytes(self._open or b"") + bytes(body[at : at + size]))
                    self.granules.append(-1)
                    done += 1
                self._open = None
                at, size = at + size, 0
        if size or (lacing and lacing[-1] == 255):
            if not skip:
                self._open = (self._open or bytearray()) + body[at : at + size]
        if done:
            self.granules[-1] = granule


def demux(data: bytes) -> tuple[dict[int, Stream], int]:
    """Logical streams by serial number, and how many pages were bad."""
    streams: dict[int, Stream] = {}
    view, at, bad = memoryview(data), 0, 0
    while (at := data.find(b"OggS", at)) >= 0 and at + HEAD.size <= len(data):
        _, version, kind, granule, serial, number, crc, count = HEAD.unpack_from(data, at)
        body = at + HEAD.size + count
        lacing = data[at + HEAD.size : body]
        end = body + sum(lacing)
        page = data[at:end]
        if version or len(lacing) < count or end > len(data) or page_crc(page[:22] + b"\0\0\0\0" + page[26:]) != crc:
            bad, at = bad + 1, at + 4
            continue
        streams.setdefault(serial, Stream(serial)).page(kind, granule, number, lacing, view[body:end])
        at = end
    return streams, bad


def timestamps(sizes: list[int], granules: list[int], rate: int) -> list[float]:
    """Start of each packet in seconds: counted from the next known granule back, else on from the last.

    sizes: samples per packet.
    """
    out, i = [0.0] * len(sizes), 0
    position = 0
    while i < len(sizes):
        j = i
        while j < len(sizes) and granules[j] < 0:
            j += 1
        if j < len(sizes):
            position = granules[j] - sum(sizes[i : j + 1])
        for k in range(i, min(j + 1, len(sizes))):
            out[k] = position / rate
            position += sizes[k]
        i = j + 1
    return out


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b" " * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def read_back(media: bytes) -> tuple[bytes, str]:
    """The samples of a medium, and its features."""
    streams, bad = demux(media)
    audio, marks = streams.get(AUDIO, Stream(AUDIO)), streams.get(MARKS, Stream(MARKS))
    rate = struct.unpack_from("<I", audio.packets[0], len(AUDIO_ID))[0] if audio.packets else RATE
    packets = audio.packets[1:]
    samples = b"".join(packets)
    starts = timestamps([len(p) for p in packets], audio.granules[1:], rate)
    x = np.frombuffer(samples, np.uint8)
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    feature = (f"streams={len(streams)} pages={audio.pages + marks.pages} bad={bad} lost={audio.lost + marks.lost} packets={len(packets)} marks={max(0, len(marks.packets) - 1)} "
               f"seconds={len(x) / rate:.6f} last_start={starts[-1] if starts else 0:.6f} sum={int(x.sum(dtype=np.int64))} peak={int(x.max(initial=0))} crossings={crossings}")
    return samples, feature


def _pieces(column: pa.Array, most: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows of bounded bytes, or single ones."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    upto, a = np.cumsum(size, dtype=np.int64), 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def _mapped(df: DataFrame, column: str, drop: tuple[str, ...], kinds: list[tuple[str, pa.DataType, str]], make) -> DataFrame:
    """The other columns, then what make(value) gives, a value for each of `kinds` (name, type, type's text); one Arrow pass."""
    ship(df.sparkSession)
    others = [c for c in df.columns if c not in (column, *drop)]
    plain = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(column).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _pieces(batch.column(batch.num_columns - 1)):
                part = batch.slice(a, b - a)
                rows = [make(x.as_py()) for x in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *[pa.array([r[i] for r in rows], k) for i, (_, k, _) in enumerate(kinds)]],
                                                 names=[*[f"c{i}" for i in range(len(others))], *[f"r{i}" for i in range(len(kinds))]])

    fields = [f"c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(others)] + [f"r{i} {t}" for i, (_, _, t) in enumerate(kinds)]
    return plain.mapInArrow(run, ", ".join(fields)).toDF(*others, *[n for n, _, _ in kinds])


_STORED = [("n_bytes", pa.int64(), "long"), ("media", pa.binary(), "binary")]
_FEATURES = [("payload_bytes", pa.int64(), "long"), ("payload_sha256", pa.string(), "string"), ("tail_crc32", pa.int64(), "long"), ("media_bytes", pa.int64(), "long"),
             ("media_sha256", pa.string(), "string"), ("feature", pa.string(), "string")]


def _stored(text: str | None) -> tuple[int, bytes]:
    n, payload = payload_of(text)
    return n, mux(payload)


def _described(media: bytes | None) -> tuple:
    if media is None:
        return (None,) * len(_FEATURES)
    samples, feature = read_back(media)
    return len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature


def _there_and_back(text: str | None) -> tuple:
    n, media = _stored(text)
    return n, *_described(media)


def store(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the text, with n_bytes and the media column, in place of columns of these names."""
    return _mapped(docs, text_col, tuple(n for n, _, _ in _STORED), _STORED, _stored)


def media_features(media: DataFrame, media_col: str = "media") -> DataFrame:
    """The rows without the media column, with what reading it back gives, in place of columns of these names."""
    return _mapped(media, media_col, tuple(n for n, _, _ in _FEATURES), _FEATURES, _described)


def round_trip(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """As media_features of store, without a media table between them: the bytes of each row are stored and read where it is."""
    return _mapped(docs, text_col, ("n_bytes", *[n for n, _, _ in _FEATURES]), [_STORED[0], *_FEATURES], _there_and_back)

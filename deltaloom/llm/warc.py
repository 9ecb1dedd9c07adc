"""WARC archives: a whole-file gzip stream is inflated once and rewritten with one member per record and an index.

`write_archives` makes archives as some crawlers leave them: all records in one gzip stream, so that nothing can be
read without inflating everything before it. `normalise` streams such a file once (several members are fine too),
writes each record as its own gzip member, and beside it an index of JSON lines: offset, length, type, id, digest.
`read_records` seeks and inflates single members by that index.

Of records with equal payloads of at least `revisit_from` bytes, that with the largest id is stored as response, the
others as revisits that refer to it; smaller ones are all responses. Rows whose id is that largest one (repeated
rows) are all responses. A null id is never the largest, unless all are null: then all are responses. Null payloads
count as empty; null URLs as the empty text; control characters in URLs are percent-encoded. Empty tables give empty
results. A truncated archive raises ValueError.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import created, opened
from .shared import cut, run_dir, ship, small

CHUNK = 1 << 20
GZIP = 31
ID = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    target = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
             f"WARC-Target-URI: {target}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def plan_revisits(pages: DataFrame, revisit_from: int) -> DataFrame:
    """id, url, payload (binary) -> with digest and refers_to."""
    p = pages.withColumn("digest", F.sha1("payload"))
    big = p.where(F.octet_length("payload") >= revisit_from)
    groups = cut(big.groupBy("digest").agg(F.max("id").alias("_last"), F.count("*").alias("_n")).where("_n > 1").select(F.col("digest").alias("_d"), "_last"))
    joined = p.join(small(groups, 80), F.col("digest") == F.col("_d"), "left")  # pages are shuffled only against very many repeats
    return joined.select("id", "url", "payload", "digest", F.when(~F.col("id").eqNullSafe(F.col("_last")), F.col("_last")).alias("refers_to"))


def write_archives(planned: DataFrame, folder: str, archive_bytes: int = 64 << 20, level: int = 6) -> DataFrame:
    """One gzip stream per archive of about archive_bytes of records; returns (archive, records)."""
    ship(planned.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        rows = (r for b in batches for r in zip(*[iter(b.column(i)) for i in range(5)]))
        waiting = next(rows, None)
        while waiting is not None:
            name, size, count = f"{task:06d}-{number:04d}.warc.gz", 0, 0
            with created(folder, name) as f:
                z = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                while waiting is not None and size < archive_bytes:
                    page_id, url, payload, digest, refers = (x.as_py() for x in waiting)
                    data = record(page_id, url, payload, digest, refers)
                    f.write(z.compress(data))
                    size, count = size + len(data), count + 1
                    waiting = next(rows, None)
                f.write(z.flush())
            number += 1
            yield pa.record_batch([pa.array([name]), pa.array([count])], names=["archive", "records"])

    return cut(planned.select("id", "url", "payload", "digest", "refers_to").mapInArrow(run, "archive string, records long"))


class _Inflated:
    """The bytes behind one or several gzip members, read in bounded chunks."""

    def __init__(self, f):
        self.f, self.z, self.buffer, self.ended = f, zlib.decompressobj(GZIP), bytearray(), False

    def more(self) -> bool:
        while not self.ended:
            data = self.z.unconsumed_tail or self.z.unused_data
            if self.z.eof:
                if not data and not (data := self.f.read(CHUNK)):
                    self.ended = True
                    return False
                self.z = zlib.decompressobj(GZIP)
            elif not data and not (data := self.f.read(CHUNK)):
                raise ValueError("the gzip stream is truncated")
            got = self.z.decompress(data, CHUNK)
            if got:
                self.buffer += got
                return True
        return False

    def until(self, end: bytes) -> bytes | None:
        """Up to and with `end`; None at the end of all bytes."""
        seen = 0
        while (at := self.buffer.find(end, max(0, seen - len(end)))) < 0:
            seen = len(self.buffer)
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("the last record is truncated")
                return None
        return self.take(at + len(end))

    def take(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self.more():
                raise ValueError("the last record is truncated")
            part = self.take(min(n, len(self.buffer)))
            n -= len(part)
            yield part


def normalise_file(source, target, level: int = 6) -> Iterator[dict]:
    """Rewrite a stream of records, one member each; yields the index entries."""
    data, at = _Inflated(source), 0
    while (head := data.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        h = headers(head)
        z = zlib.compressobj(level, zlib.DEFLATED, GZIP)
        size = target.write(z.compress(head)) or 0
        member = [z.compress(p) for p in data.pieces(int(h["content-length"]))]
        for _ in data.pieces(4):
            pass
        whole = b"".join(member) + z.compress(b"\r\n\r\n") + z.flush()
        size += target.write(whole) or 0
        yield {"offset": at, "length": size, "type": h.get("warc-type"), "id": h.get("warc-record-id"), "digest": h.get("warc-payload-digest")}
        at += size


def normalise(archives: DataFrame, folder: str, target: str, level: int = 6) -> DataFrame:
    """(archive, records) -> (archive, records): normalised files in `target`, each with <archive>.idx beside it."""
    ship(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                entries = 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as source, created(target, name) as out, created(target, f"{name}.idx") as index:
                    for e in normalise_file(source, _Counted(out), level):
                        index.write(json.dumps(e).encode() + b"\n")
                        entries += 1
                yield pa.record_batch([pa.array([name]), pa.array([entries])], names=["archive", "records"])

    return cut(archives.select("archive", "records").mapInArrow(run, "archive string, records long"))


class _Counted:
    """write() that tells how much it wrote, whatever the stream below returns."""

    def __init__(self, f):
        self.f = f

    def write(self, data: bytes) -> int:
        self.f.write(data)
        return len(data)


def read_records(archives: DataFrame, folder: str) -> DataFrame:
    """Each record by its index entry: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    ship(archives.sparkSession)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def number(x: str | None) -> int | None:
        x = (x or "").strip("<>").removeprefix(ID)
        return int(x) if x else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{path}/{name}.idx", compression=None) as f:
                    entries = [json.loads(x) for x in f.read().splitlines()]
                rows = []
                with fs.open_input_file(f"{path}/{name}") as f:
                    for e in entries:
                        f.seek(e["offset"])
                        data = zlib.decompress(f.read(e["length"]), GZIP)
                        head, _, rest = data.partition(b"\r\n\r\n")
                        h = headers(head)
                        http, _, payload = rest[: int(h["content-length"])].partition(b"\r\n\r\n")
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        if h["warc-type"] == "response":
                            size, found = len(payload), hashlib.sha1(payload).hexdigest()
                            if found != digest:
                                raise ValueError(f"{name}, {e['id']}: the payload's digest is {found}, not {digest}")
                        else:  # the full payload's length is in the HTTP header that a revisit keeps
                            size = int(headers(http)["content-length"])
                        rows.append((number(h["warc-record-id"]), size, digest, h["warc-type"], number(h.get("warc-refers-to"))))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return archives.select("archive").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_from: int = 1000) -> DataFrame:
    """Write, normalise and read back; one row per page."""
    spark = ship(pages.sparkSession)
    folder = run_dir(spark, "warc")
    text = F.col(payload_col)
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(text.cast("binary"), F.lit("").cast("binary")).alias("payload"))
    written = write_archives(plan_revisits(src, revisit_from), f"{folder}/raw")
    done = normalise(written, f"{folder}/raw", f"{folder}/members")
    return read_records(done, f"{folder}/members")

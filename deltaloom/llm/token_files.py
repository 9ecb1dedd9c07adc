"""Token counts from flat token files: documents are found by their end-of-document identifiers alone.

`write_tokens` tokenises texts with a public byte-level BPE vocabulary (a parameter; the ranks travel by broadcast) and
writes flat files of 16-bit identifiers, each document followed by the end identifier; a file keeps no index.

`scan` cuts files in blocks of a fixed number of tokens, which are read by seeking and searched by one vectorised
comparison each. A document that crosses blocks is stitched by a prefix scan over the blocks of its file: how many
ends there are before a block, and where the last one is. Tokens behind a file's last end are a document too.

Null or empty texts are documents of 0 tokens. Repeated rows are documents of their own. Texts are tokenised whole.
Strings that look like special tokens are ordinary text. Empty tables and empty files give empty results.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .files import created, opened
from .shared import cut, run_dir, ship

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splits texts before merging; belongs to the vocabulary (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
BLOCK = 1 << 20
_made: dict = {}


def encoder(ranks: bytes, pattern: str):
    import tiktoken

    key = (len(ranks), pattern)
    if key not in _made:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _made[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _made[key]


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN,
                 end: int = END, file_tokens: int = 16 << 20) -> DataFrame:
    """Flat files of uint16 in `folder`; returns (file, tokens, ids): how long each is and the ids in its order."""
    spark = ship(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        held = spark.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(held.value, pattern)
        rows = ((i, t) for b in batches for i, t in zip(b.column(0), b.column(1)))
        task, number, waiting = TaskContext.get().partitionId(), 0, next(rows, None)
        while waiting is not None:
            name, size, ids = f"{task:06d}-{number:04d}.bin", 0, []
            with created(folder, name) as f:
                while waiting is not None and size < file_tokens:
                    tokens = coder.encode_ordinary(waiting[1].as_py() or "")
                    f.write(np.array([*tokens, end], "<u2").tobytes())
                    size += len(tokens) + 1
                    ids.append(waiting[0])
                    waiting = next(rows, None)
            number += 1
            yield pa.record_batch([pa.array([name]), pa.array([size]), pa.array([[x.as_py() for x in ids]], pa.list_(ids[0].type))], names=["file", "tokens", "ids"])

    return cut(docs.select(id_col, text_col).mapInArrow(run, f"file string, tokens long, ids array<{kind}>"))


def scan(files: DataFrame, folder: str, ends: tuple[int, ...] = (END,), block: int = BLOCK) -> DataFrame:
    """files: (file, tokens). One row per document: file, ordinal, first_token, n_tokens."""
    spark = ship(files.sparkSession)
    blocks = (
        files.where("tokens > 0").select("file", "tokens", F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / block))).alias("block"))
        .repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file", "block")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for b in batches:
            out = []
            for name, total, i in zip(*(x.to_pylist() for x in b.columns)):
                first = i * block
                with fs.open_input_file(f"{path}/{name}") as f:
                    f.seek(2 * first)
                    tokens = np.frombuffer(f.read(2 * min(block, total - first)), "<u2")
                hit = tokens == ends[0]
                for e in ends[1:]:
                    hit |= tokens == e
                at = np.flatnonzero(hit).astype(np.int64) + first
                if first + len(tokens) == total and not hit[-1]:  # the file's last document has no end
                    at = np.append(at, total)
                out.append((name, i, at))
            yield pa.record_batch([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.int64()))], names=["file", "block", "at"])

    found = cut(blocks.mapInArrow(run, "file string, block long, at array<long>"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = (
        found.withColumn("_last", F.when(F.size("at") > 0, F.element_at("at", -1)))
        .withColumn("_seen", F.coalesce(F.sum(F.size("at").cast("long")).over(before), F.lit(0)))
        .withColumn("_end", F.coalesce(F.max("_last").over(before), F.lit(-1)))
    )
    return stitched.select("file", "_seen", "_end", "at", F.posexplode("at").alias("i", "end")).select(
        "file", (F.col("_seen") + F.col("i")).alias("ordinal"),
        (F.when(F.col("i") == 0, F.col("_end")).otherwise(F.get("at", F.col("i") - 1)) + 1).alias("first_token"), "end"
    ).select("file", "ordinal", "first_token", (F.col("end") - F.col("first_token")).alias("n_tokens"))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write the texts as token files, scan these, and give each document's id its count back."""
    folder = run_dir(ship(docs.sparkSession), "tokens")
    files = write_tokens(docs, folder, id_col, text_col, **options)
    counts = scan(files.select("file", "tokens"), folder)
    ids = files.select(F.col("file").alias("_f"), F.posexplode("ids").alias("_o", "id"))
    return counts.join(ids, (F.col("file") == F.col("_f")) & (F.col("ordinal") == F.col("_o"))).select("id", "file", "ordinal", "first_token", "n_tokens")

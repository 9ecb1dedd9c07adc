"""Chat formatting: every assistant turn becomes an example of its own, with all turns before it as context.

A turn is written `<|role|>text</s>`; an example is the turns of its context and then its reply; only the reply's text
is under the loss mask, a span of characters. What follows the last assistant turn, or a conversation without one, is
an example with an empty mask, so no turn is lost.

Control strings (`<|...|>`, `<s>`, `</s>`, `[INST]`, `[/INST]`) inside texts get a backslash in front; backslashes that
stand before one, or at the text's end, are doubled. So a control string behind an even number of backslashes is real,
behind an odd number it is text, and `parse` gives back what `format_turn` got.

Turns are put in order by a sort within partitions and streamed; a task holds one conversation's context at a time.
Null texts and roles count as empty; null turns come first; equal turn numbers go by role and text. Null conversation
ids are one conversation. Roles are percent-encoded where they are not letters, digits, `_` or `-`. Repeated rows are
turns of their own. Extra columns are not carried. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import partitions, ship

CONTROL = r"<\|[^|]*\|>|</?s>|\[/?INST\]"
_ESCAPE = re.compile(rf"(\\*)({CONTROL})|(\\+)\Z")
_REAL = re.compile(rf"(\\*)({CONTROL})")
END = "</s>"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[3] * 2 if m[3] else m[1] * 2 + "\\" + m[2], text)


def format_turn(role: str, text: str) -> tuple[str, str]:
    """The turn's opening, and its text with its end."""
    return f"<|{quote(role, safe='')}|>", escape(text)


def tokens(s: str) -> Iterator[tuple[bool, str]]:
    """(is control, string) pieces of a formatted text, texts unescaped."""
    at, held = 0, []
    for m in _REAL.finditer(s):
        held.append(s[at : m.start()] + "\\" * (len(m[1]) // 2))
        if len(m[1]) % 2:
            held.append(m[2])
        else:
            yield False, "".join(held)
            held = []
            yield True, m[2]
        at = m.end()
    yield False, "".join(held) + s[at:]


def parse(s: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    out, role, text = [], None, ""
    for control, x in tokens(s):
        if not control:
            text = x
        elif x == END:
            out.append((role, text))
        else:
            role = unquote(x[2:-2])
    return out


def unescape(s: str) -> str:
    """The text of a span that ends where its turn ends."""
    return next((x for control, x in tokens(s + END) if not control), "")


EXAMPLE = ["conv_id", "example", "text", "loss_start", "loss_end", "last"]


def expand(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trainable: str = "assistant") -> DataFrame:
    """conv_id, example (from 0), text, loss_start, loss_end, last; a conversation's examples stand together in order."""
    spark = ship(turns.sparkSession)
    kind = turns.schema[conv_col].dataType.simpleString()
    ordered = (
        turns.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("t"), F.coalesce(role_col, F.lit("")).alias("r"), F.coalesce(text_col, F.lit("")).alias("x"))
        .repartition(partitions(spark), "c").sortWithinPartitions("c", "t", "r", "x").select("c", "r", "x")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context: list[str] = []
        size, number, conv, begun, pending = 0, 0, None, False, False
        rows: list[tuple] = []
        held: tuple | None = None  # the example before, until it is known whether it is the last
        chars = 0

        def batch(kind) -> pa.RecordBatch:
            kinds = [kind, pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=EXAMPLE)

        kind = pa.int64()
        for b in batches:
            kind = b.column(0).type
            for c, role, text in zip(*(x.to_pylist() for x in b.columns)):
                if begun and c != conv:
                    if pending:
                        rows += [(*held, False)] if held else []
                        held = (conv, number, "".join(context), size, size)
                    rows.append((*held, True))
                    context, size, number, held, pending = [], 0, 0, None, False
                conv, begun = c, True
                head, body = format_turn(role, text)
                context += [head, body, END]
                start = size + len(head)
                size = start + len(body) + len(END)
                pending = role != trainable
                if not pending:
                    if held:
                        rows.append((*held, False))
                    held = (conv, number, "".join(context), start, start + len(body))
                    number += 1
                    chars += size
                if chars > 1 << 22:
                    yield batch(kind)
                    rows, chars = [], 0
        if begun:
            if pending:
                rows += [(*held, False)] if held else []
                held = (conv, number, "".join(context), size, size)
            rows.append((*held, True))
            yield batch(kind)

    return ordered.mapInArrow(run, f"conv_id {kind}, example int, text string, loss_start long, loss_end long, last boolean")


def read_back(examples: DataFrame) -> DataFrame:
    """One row per conversation, from its formatted examples alone."""
    kind = examples.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, loss_chars, chars, count = hashlib.sha256(), 0, 0, 0
        for b in batches:
            rows = []
            for conv, _, text, a, z, last in zip(*(x.to_pylist() for x in b.columns)):
                got = unescape(text[a:z]) if z > a else ""
                loss.update(got.encode("utf-8", "surrogatepass"))
                loss_chars, chars, count = loss_chars + len(got), chars + len(text), count + 1
                if last:
                    turns = parse(text)
                    every = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append((conv, len(turns), every, loss_chars, loss.hexdigest(), chars, count))
                    loss, loss_chars, chars, count = hashlib.sha256(), 0, 0, 0
            kinds = [b.column(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return examples.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long")

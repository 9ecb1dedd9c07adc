"""Ogg, WARC, chat and token files: exact round trips."""

import gzip
import hashlib
import io
import json
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deltaloom.llm import chat, ogg, token_files, warc

from .fixtures import sentence


def slow_crc(data):
    c = 0
    for x in data:
        c ^= x << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
    return c


@given(st.binary(max_size=300))
@settings(max_examples=100, deadline=None)
def test_page_crc(data):
    assert ogg.page_crc(data) == slow_crc(data)


@given(st.lists(st.integers(0, 70_000), max_size=6), st.integers(0, 2**32 - 1))
@settings(max_examples=50, deadline=None)
def test_packets_of_any_size(sizes, serial):
    out, packets, at = [], [], 0
    w = ogg.Writer(serial, out)
    for i, n in enumerate(sizes):
        packets.append(bytes([i]) * n)
        at += n
        w.packet(packets[-1], at)
    w.flush(last=True)
    streams, bad = ogg.demux(b"junk" + b"".join(out) + b"Ogg")
    assert bad == 0 and streams[serial].packets == packets and streams[serial].ended
    starts = ogg.timestamps(list(map(len, packets)), streams[serial].granules, 1)
    assert starts == [float(sum(sizes[:i])) for i in range(len(sizes))]


def test_damage_is_noticed():
    _, payload = ogg.payload_of(sentence(1, 60_000))
    media = ogg.mux(payload)
    assert ogg.read_back(media)[0] == payload
    at = media.index(b"OggS", len(media) // 2)
    while ogg.HEAD.unpack_from(media, at)[4] != ogg.AUDIO:
        at = media.index(b"OggS", at + 4)
    broken = media[: at + 40] + bytes([media[at + 40] ^ 1]) + media[at + 41 :]
    streams, bad = ogg.demux(broken)
    assert bad == 1 and sum(s.lost for s in streams.values()) >= 1
    whole = ogg.demux(media)[0][ogg.AUDIO].packets
    assert all(p in whole for p in streams[ogg.AUDIO].packets) and len(streams[ogg.AUDIO].packets) < len(whole)


def test_media_query(spark):
    texts = ["", None, "a", "a", "é" * 96, "x" * 193, sentence(3, 60_000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, feature string")
    got = {r.doc_id: r for r in ogg.media_features(ogg.store(df)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        p = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
    assert got[2][2:] == got[3][2:] and got[0][2:] == got[1][2:] and got[2].media_sha256 != got[0].media_sha256
    assert ogg.media_features(ogg.store(df.limit(0))).count() == 0


def test_warc(spark):
    big = "<p>" + sentence(1, 300)
    rows = [(1, "http://a/1", big), (5, "http://a/2\r\nX: y", big), (3, None, big), (2, "http://é/", "small"), (7, "u", "small"), (9, "u", None), (10, "u", ""), (None, "u", big), (5, "http://a/2", big), (11, "u", "é\r\n\r\n" * 400), (12, "u", "x" * 300_000)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string").repartition(2)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()), key=str)
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        again = len(p) >= 1000 and h == big and i != 5
        want.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", 5 if again else None))
    assert got == sorted(want, key=str)
    assert warc.round_trip(df.limit(0)).collect() == []


def test_normalise_file():
    recs = [warc.record(i, f"u{i}", b"p" * (i * 100_000), hashlib.sha1(b"p" * (i * 100_000)).hexdigest(), None) for i in range(5)]
    for source in (gzip.compress(b"".join(recs)), gzip.compress(b"".join(recs[:2])) + gzip.compress(b"".join(recs[2:]))):
        out = io.BytesIO()
        index = list(warc.normalise_file(io.BytesIO(source), out))
        data = out.getvalue()
        assert [zlib.decompress(data[e["offset"] : e["offset"] + e["length"]], 31) for e in index] == recs
        assert gzip.decompress(data) == b"".join(recs) and json.dumps(index)
    for bad in (gzip.compress(recs[1][:-50]), gzip.compress(b"".join(recs))[:-20]):
        with pytest.raises(ValueError):
            list(warc.normalise_file(io.BytesIO(bad), io.BytesIO()))


chat_text = st.text(st.sampled_from("ab\\<>|/s[]INST \né"), max_size=25) | st.sampled_from(["</s>", "\\</s>", "[INST] x \\", "<|user|>", "\\\\", "<s>\\\\[/INST]"])


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool x|>"]), chat_text), min_size=1, max_size=5))
@settings(max_examples=300, deadline=None)
def test_turns_round_trip(turns):
    parts = [chat.format_turn(r, t) for r, t in turns]
    whole = "".join(h + b + chat.END for h, b in parts)
    assert chat.parse(whole) == turns
    assert [chat.unescape(b) for _, b in parts] == [t for _, t in turns]


def test_examples(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", "hi </s>"), (1, 2, "assistant", "yes"), (1, 3, "user", None), (1, 4, "assistant", "no\\"), (1, 5, "user", "bye"), (2, 0, "user", "alone"), (3, 0, "assistant", ""),
            (4, None, None, "first"), (4, 1, "assistant", "a"), (4, 1, "assistant", "a"), (None, 0, "user", "x"), (None, 1, "assistant", "y" * 5_000_000)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, example string").repartition(3)
    examples = chat.expand(df)
    spans = {(r.conv_id, r.example): r for r in examples.where("conv_id = 1").collect()}
    assert [chat.unescape(spans[1, i].text[spans[1, i].loss_start : spans[1, i].loss_end]) for i in range(3)] == ["yes", "no\\", ""]
    assert spans[1, 1].text.startswith(spans[1, 0].text) and spans[1, 2].last and not spans[1, 1].last
    got = {r.conv_id: r for r in chat.read_back(examples).collect()}
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.expand(df.limit(0))).count() == 0


def test_token_counts(spark):
    with open(token_files.VOCABULARY, "rb") as f:
        coder = token_files.encoder(f.read(), token_files.PATTERN)
    texts = ["", None, "a", "<|endoftext|> x", sentence(5, 3000), "é漢 " * 50, "same", "same"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "q", 1)], "doc_id long, text string, n_tokens int").repartition(2)
    got = {r.id: r.n_tokens for r in token_files.token_counts(df, file_tokens=500).collect()}
    assert got == {i: len(coder.encode_ordinary(t or "")) for i, t in [*enumerate(texts), (None, "q")]}
    assert token_files.token_counts(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 2, 7, 1000])
def test_scan_of_flat_files(spark, tmp_path, block):
    rng = np.random.default_rng(4)
    files, want = [], []
    for name, n in (("a", 100), ("b", 37), ("none", 0), ("ends", 8)):
        x = rng.integers(0, 6, n).astype("<u2")
        if name == "ends":
            x[-1] = 5
        (tmp_path / name).write_bytes(x.tobytes())
        files.append((name, n))
        at, k = 0, 0
        for i in [*np.flatnonzero((x == 5) | (x == 3)).tolist(), *([n] if n and x[-1] not in (3, 5) else [])]:
            want.append((name, k, at, i - at))
            at, k = i + 1, k + 1
    df = spark.createDataFrame(files, "file string, tokens long")
    assert sorted(map(tuple, token_files.scan(df, str(tmp_path), (5, 3), block).collect())) == sorted(want)

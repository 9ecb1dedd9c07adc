"""Decontamination, toxicity, URL rules, mixing."""

import re
import zlib

import numpy as np
import pytest

from deltaloom.llm import decontaminate as D
from deltaloom.llm import mixing, toxicity, url_filter
from deltaloom.llm.url_filter import Rule

from .fixtures import TO_LOWER, edited, sentence


def grams(text, k=5):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate(TO_LOWER))
    k = min(k, len(w))
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if k else [], w


def leaks():
    items = [sentence(1000 + i, 15 + i) for i in range(20)] + ["", None, "tiny item", sentence(1000, 15)]
    docs = [sentence(i, 300) for i in range(10)]
    docs += [sentence(20, 140) + "\n" + items[3].upper() + "! " + sentence(21, 200), items[5], edited(items[19], 3) + " " + sentence(22, 50), sentence(23, 90) + " " + " ".join(items[6].split(" ")[:8])]
    docs += [sentence(24, 5000) + " " + items[7], items[0] + " " + items[1], "", None, "a tiny item here", " ".join(reversed(items[8].split(" ")))]
    return items, docs


def brute_leaks(items, docs):
    out = set()
    for i, t in enumerate(docs):
        for j, item in enumerate(items):
            g, w = grams(item)
            if not g:
                continue
            there = set(grams(t, len(g[0]))[0]) if t else set()
            hit = [x in there for x in g]
            m = (len(g) + 1) // 2
            if np.mean(hit) >= 0.8 and np.mean(hit[:m]) >= 0.5 and (len(g) == 1 or np.mean(hit[m:]) >= 0.5):
                out.add((i, j))
    return out


@pytest.mark.parametrize("slice_bytes", [5000, 1 << 20])
def test_leaks_against_brute_force(spark, slice_bytes):
    items, docs = leaks()
    d = spark.createDataFrame([(i, t, i) for i, t in enumerate(docs)], "doc_id long, text string, item long").repartition(3)
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = brute_leaks(items, docs)
    assert len(want) >= 7
    got = D.find_leaks(d, b, slice_bytes=slice_bytes).collect()
    assert {(r.id, r.item) for r in got} == want and len(got) == len(want)
    kept = D.drop_leaks(d, b, slice_bytes=slice_bytes)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {i for i, _ in want}


def test_open_windows_are_those_that_a_full_sum_opens():
    """The commonest terms are left out at first; no window that all terms' maxima would open may be lost by that."""
    texts = [sentence(i % 30, 10 + i % 17) + " the of and" for i in range(400)]
    index = D.Index(texts)
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(len(index.terms), rng.integers(1, 60), replace=False)) for _ in range(300)]
    for x in texts[:100]:
        w = D._words_of([x])[0]
        rows.append(np.unique(np.searchsorted(index.terms, w)))
    term, first = np.concatenate(rows), np.cumsum([0, *map(len, rows)])[:-1]
    dense = np.zeros((len(index.terms), index.blocks))
    for t in range(len(index.terms)):
        at = slice(index.block_start[t], index.block_start[t + 1])
        dense[t, index.block[at]] = index.block_max[at]
    for threshold in (0.2, 0.6, 0.95):
        for cells in (1 << 21, 500):
            D.CELLS, old = cells, D.CELLS
            got = sorted(index._open_windows(term, first, threshold))
            D.CELLS = old
            want = [(int(a), int(a) + len(r)) for a, r in zip(first, rows) if (dense[r].sum(axis=0) >= threshold * (1 - 1e-4)).any()]
            assert got == want and (threshold == 0.95 or len(want) > 50)


def test_scores_do_not_hang_on_slices(spark):
    items, docs = leaks()
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").coalesce(1)
    a, c = (sorted((r.id, r.item, round(r.score, 9)) for r in D.find_leaks(d, b, slice_bytes=n).collect()) for n in (3000, 1 << 20))
    assert a == c


def test_many_items():
    """An index of 20,000 items stays small, and looks at a long text in bounded memory."""
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(30_000)]
    p = 1 / np.arange(1, 30_001)
    words = rng.choice(vocabulary, (20_000, 40), p=p / p.sum())
    items = [" ".join(w) for w in words]
    index = D.Index(items)
    assert index.bytes < 64 << 20
    text = " ".join(rng.choice(vocabulary, 20_000, p=p / p.sum())) + " " + items[777] + " " + " ".join(rng.choice(vocabulary, 5000, p=p / p.sum()))
    found = [(r, h.item) for c in D.K.chunks(D.pa.array(["", text])) for r, h in index.find(D.K.words(c, D.K.WORD_CHAR), 64, 0.6, 0.8, 0.5)]
    assert found == [(1, 777)]


def test_leaks_odd_tables(spark):
    items, docs = leaks()
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(None, items[5])], "doc_id long, text string")
    some = spark.createDataFrame([(5, items[5]), (5, items[5])], "item_id long, text string")
    assert D.find_leaks(d, some).collect() == [] and D.find_leaks(full, b).collect() == [] and D.drop_leaks(full, b).count() == 1
    assert [(r.id, r.item) for r in D.find_leaks(full, some).collect()] == [(None, 5), (None, 5)]
    assert D.drop_leaks(full, some).count() == 0


def test_wand_finds_what_full_scoring_finds():
    index = D.Index([sentence(i % 9, 12 + i) for i in range(50)])
    rng = np.random.default_rng(0)
    for _ in range(60):
        terms = np.sort(rng.choice(len(index.terms), rng.integers(1, len(index.terms)), replace=False))
        score = np.zeros(50)
        for t in terms:
            at = slice(index.start[t], index.start[t + 1])
            score[index.item[at]] += index.impact[at]
        for threshold in (0.1, 0.5, 0.9):
            got = dict(index.wand(terms, threshold))
            assert set(got) == set(np.flatnonzero(score >= threshold * (1 - 1e-6)))
            assert all(abs(got[i] - score[i]) < 1e-9 for i in got)


def brute_segments(x):
    """Maximal segments by their definition: the best run, then left and right of it."""
    best = max(((sum(x[i:j]), -(j - i), i, j) for i in range(len(x)) for j in range(i + 1, len(x) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    s, _, i, j = best
    return [(i, j - i, s)] + brute_segments(x[:i]) + [(a + j, n, s) for a, n, s in brute_segments(x[j:])]


def test_segments():
    rng = np.random.default_rng(2)
    for _ in range(300):
        x = rng.normal(-0.2, 1, rng.integers(0, 14))
        total = np.concatenate([[0], np.cumsum(x)])
        at = np.flatnonzero(x > 0)
        got = sorted(toxicity.segments(at, total[at], total[at + 1]))
        assert [(a, n) for a, n, _ in got] == [(a, n) for a, n, _ in sorted(brute_segments(list(x)))]


def test_toxicity(spark):
    rude = "grunk blarg fnord zonk".split()
    docs, labels = [], []
    for i in range(400):
        w = sentence(i, 40 + i % 50).split(" ")
        if i % 5 == 0:
            for k in range(3):
                w.insert(i * 7 % len(w) + k, rude[(i + k) % 4] + ("" if i % 2 else "ish"))
        docs.append(" ".join(w))
        labels.append(int(i % 5 == 0))
    docs += ["", None, "grunkology " + "word " * 10 + "blarging fnordian zonker"]
    d = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(docs)], "doc_id long, text string, _score2 double").repartition(3)
    lab = spark.createDataFrame([(i, x) for i, x in enumerate(labels)] + [(1, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    m = toxicity.train(d, lab, prior=100.0)
    got = {r.doc_id: r for r in toxicity.score(d, m).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 100
    assert sum((got[i]._score >= 0.7) == bool(labels[i]) for i in held) >= 0.97 * len(held)
    assert got[400]._score < 0.5 and got[401]._score < 0.5 and got[402]._score > 0.7 and got[0]._score2 == 0.5
    assert got[0]._passages and 1 <= got[0]._passages[0].tokens <= 6
    again = {r.doc_id: r._score for r in toxicity.score(d.repartition(7), toxicity.train(d.repartition(2), lab, prior=100.0)).collect()}
    assert all(abs(again[i] - got[i]._score) < 1e-9 for i in again)
    none = toxicity.train(d, lab.limit(0))
    assert toxicity.score(d, none).where("_score > 0.01").count() == 0
    assert toxicity.score(d.limit(0), m).count() == 0 and toxicity.score(d, toxicity.train(d.limit(0), lab)).count() == len(docs)


RULES = [Rule("com", "/en/", "block"), Rule("example.com", "/en/7", "allow"), Rule("example.com", "/en/7", "block"), Rule("", "/ads", "block"), Rule("a.b.net", "", "block"), Rule("b.net", "/x/y/z", "allow")]
URLS = ["http://q.example.com/en/7/1?x", "https://EXAMPLE.com/en/8", "http://notexample.com/en/7", "http://com/en/", "http://x.org/ads/1", "no url", None, "", "://", "ftp://A.b.NET", "http://c.a.b.net/x/y/z",
        "http://b.net/x/y/zz#f", "http://x.com?/en/", "http://u/ads://v", "http://É.com/en/é"]


def brute_rule(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(TO_LOWER), m[2]) if m else ("", "")
    fits = [r for r in RULES if (r.host == "" or host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host.split(".")) if r.host else 0, len(r.path), r.verdict == "allow"), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


@pytest.mark.parametrize("limit", [1000, 2])
def test_urls(spark, limit):
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string, host string")
    got = url_filter.filter_urls(df, "url", RULES, broadcast_limit=limit).collect()
    assert len(got) == len(URLS) + 3
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute_rule(r.url), r.url
    made = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_filter.filter_urls(df, "url", made, broadcast_limit=limit).where("verdict = 'block'").count() == sum(r.verdict == "block" for r in got)
    assert url_filter.filter_urls(df.limit(0), "url", RULES, broadcast_limit=limit).count() == 0
    assert url_filter.filter_urls(df, "url", [], "block", limit).where("verdict = 'block'").count() == len(got)


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        part = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if part[s] > 2 * sizes[s]}
        if not over:
            return out | part
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mixing(spark):
    rows = [(i, " ".join(["w"] * (i * 37 % 50)) if i % 13 else None, [None, "a", "b", "b", "b", "é", "z"][i * i % 7]) for i in range(600)]
    rows += [(7, "twice the same row", "a")] * 2 + [(None, "no id", "b"), (1000, "lonely", "empty?"), (1001, None, "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, rows_per_range=20, keep=("doc_id", "source")).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, taken = brute_targets(sizes), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert taken[s] == int(want[s] + 1e-9), s
    again = mixing.mix(df.repartition(5), rows_per_range=1000, keep=("doc_id", "source")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(df.limit(0)).collect() == []


def test_urls_keep_other_columns(spark):
    df = spark.createDataFrame([(1, "http://a.com/en/" + "x" * 200_000, 7, 8), (1, None, 9, None)], "page_id long, url string, _judged int, verdict int")
    got = url_filter.filter_urls(df, "url", [Rule("com", "/en/", "block")]).orderBy("_judged").collect()
    assert [(r.page_id, r._judged, r.rule, r.verdict) for r in got] == [(1, 7, "com/en/", "block"), (1, 9, None, "allow")] and len(got[0].path) == 200_004

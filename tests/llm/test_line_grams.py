"""Line dedup by character grams, against the edit distance of all pairs."""

import numpy as np
import pyarrow as pa

from deltaloom.llm import edits as E
from deltaloom.llm import line_dedup as L

from .fixtures import components, edited, sentence
from .test_near import line_corpus, norm


def all_gone(docs, min_words=5, similarity=0.9):
    """Lines that go by edit distance alone, with no rule for candidates."""
    occ = {}
    for i, t in enumerate(docs):
        for n, line in enumerate((t or "").split("\n")):
            if x := norm(line):
                occ.setdefault(x, []).append((i, n))
    # repeats of short lines go; long ones, by words or characters, are compared by edits
    forms, links = sorted(occ, key=lambda x: len(x.split(" ")) < min_words and len(x) < 20), []
    long = sum(len(x.split(" ")) >= min_words or len(x) >= 20 for x in forms)
    for a, x in enumerate(forms[:long]):
        later = forms[a + 1 : long]
        near = E.distances(pa.array([x] * len(later), pa.string()), pa.array(later, pa.string()), similarity) >= 0
        links += [(a, a + 1 + int(b)) for b in np.flatnonzero(near)]
    top, groups, gone = components(len(forms), links), {}, set()
    for i, x in enumerate(forms):
        groups.setdefault(top[i], []).extend(occ[x])
    for g in groups.values():
        gone |= {x for x in g if x != min(g)}
    return gone


def gone_of(spark, docs, **more):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in L.dedup_lines(df, **more).collect()}
    assert len(got) == len(docs)
    return got


def check(spark, docs, want, **more):
    for i, r in gone_of(spark, docs, **more).items():
        gone = {n for d, n in want if d == i}
        left = None if docs[i] is None else "\n".join(x for n, x in enumerate(docs[i].split("\n")) if n not in gone)
        assert (r.text, r._removed) == (left, len(gone)), i


def changed(line, rng, share):
    x = list(line)
    for p in rng.choice(len(x), int(len(x) * share), replace=False):
        x[p] = "qxzj"[rng.integers(4)]
    return "".join(x)


def test_grams_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    docs = line_corpus()
    docs += [edited(sentence(300 + i, n), k) for i in range(8) for n in (10, 20, 40) for k in (0, n // 2, n - 1)]  # one word changed
    docs += [changed(sentence(400 + i, 30), rng, 0.02) for i in range(10) for _ in range(3)]  # scattered characters
    check(spark, docs, all_gone(docs), grams=True)


def test_chain_of_edits(spark):
    # each line is near to its neighbours only, so no single centre links them
    line, docs = sentence(500, 30), []
    for i in range(30):
        docs.append(line)
        line = edited(line, i)
    want = all_gone(docs)
    assert len(want) == 29
    check(spark, docs, want, grams=True)


def test_two_words_of_twenty(spark, tmp_path):
    # a tenth of the words differ, which is hard for SimHashes: grams find all, the query exactly those that its rule admits
    from deltaloom.llm import queries
    from deltaloom.llm import kernels as K
    from deltaloom.llm import line_grams as G
    from deltaloom.llm import line_simhash as S
    from .test_near import candidates

    docs = [edited(sentence(600 + i, 20), k) for i in range(10) for k in (3, 11)]
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = all_gone(docs)
    assert len(want) == 10
    check(spark, docs, want, grams=True)
    got = queries.QUERIES["op10_line_dedup"](spark, str(tmp_path)).toPandas()
    c = next(K.chunks(pa.array(docs)))
    found = candidates(*S.simhashes(*G.normal_lines(c)[3:]))
    assert got["n_removed"].sum() == sum((i, i + 1) in found for i in range(0, 20, 2)) >= 8


def test_short_lines(spark):
    han = "".join(chr(0x4E00 + i * 37 % 2000) for i in range(60))
    docs = ["and ornd\nAll rights reserved\n...", "and ornd!\nsomething else", "All  rights reserved.\n...", han + "\nab", han[:30] + "X" + han[31:], han, "ab\nand ornt"]
    got = gone_of(spark, docs, grams=True)
    assert [got[i].text for i in range(len(docs))] == [docs[0], "something else", "...", docs[3], "", "", "and ornt"]

"""The queries on the smallest tables, and the pipeline's stages against brute force."""

import duckdb
import pytest

import corpus_pipeline
from deltaloom.llm import queries

from .fixtures import WORD, components, near_pairs
from .test_near import brute_lines
from .test_text_ops import brute_leaks


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, duck, sf_dir, name):
    from tests.test_queries import rows

    df = queries.QUERIES[name](spark, sf_dir)
    want = duck.sql(queries.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontaminate", "mixing"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts)

    lines = steps["line_dedup"](spark, docs, sf_dir)
    assert lines.columns == columns
    after = {r.doc_id: r for r in lines.collect()}
    gone, _ = brute_lines([texts[i] for i in ids])
    for k, i in enumerate(ids):
        left = "\n".join(x for n, x in enumerate((texts[i] or "").split("\n")) if n not in gone.get(k, ()))
        scraps = not any(c.isalnum() for c in left) or len(WORD.findall(left)) < corpus_pipeline.LEAST_LEFT * len(WORD.findall(texts[i] or ""))
        if i in after:
            assert after[i].text == left and (not gone.get(k) or (after[i].n_chars == len(left) and not scraps))
        else:
            assert gone[k] and scraps

    near = steps["ngram_join"](spark, docs, sf_dir)
    _, links = near_pairs([texts[i] for i in ids])
    kept = {r.doc_id for r in near.collect()}
    assert near.columns == columns
    assert kept == {ids[x] for x in set(components(len(ids), links))}

    clean = steps["decontaminate"](spark, docs, sf_dir)
    items = [r[0] for r in duckdb.sql(f"select text from '{sf_dir}/benchmark.parquet' order by item_id").fetchall()]
    assert {r.doc_id for r in clean.collect()} == set(ids) - {ids[i] for i, _ in brute_leaks(items, [texts[i] for i in ids])}

    calm = steps["toxicity"](spark, docs, sf_dir)
    assert calm.columns == columns and calm.count() > 0.8 * len(ids)


def test_no_copy_survives_as_scraps(spark, sf_dir):
    """Line dedup, then the join: of the documents that were near copies at first none is left with less than a tenth of its words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(texts)
    top = components(len(ids), near_pairs([texts[i] for i in ids])[1])
    copies = {ids[i] for i in range(len(ids)) if top[i] != i}
    assert len(copies) > 5
    steps = dict(corpus_pipeline.STAGES)
    left = {r.doc_id: r.text for r in steps["ngram_join"](spark, steps["line_dedup"](spark, docs, sf_dir), sf_dir).collect()}
    assert not [i for i in copies & set(left) if len(WORD.findall(left[i])) < 0.1 * len(WORD.findall(texts[i]))]
    assert len(copies & set(left)) < 0.3 * len(copies)


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert out and len({r.doc_id for r in out}) == len(out)
    total = {}
    for r in out:
        total[r.source] = total.get(r.source, 0) + r.taken
        assert r.taken <= 2 * r.size
    assert all(total[r.source] == int(r.target) for r in out)


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_nothing_needs_the_subpackage():
    import ast
    from pathlib import Path

    for p in Path(queries.__file__).parent.parent.rglob("*.py"):
        if p.parent.name != "llm":
            for node in ast.walk(ast.parse(p.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any("llm" in n.split(".") for n in names), p

"""What executors' workers hold: all is given back, and pieces are small."""

import pyarrow as pa
import pytest

import corpus_pipeline
from deltaloom.llm import decontaminate as D

from .fixtures import sentence


@pytest.fixture
def functions(spark, monkeypatch):
    """The functions that go to mapInArrow, by the schema they give."""
    seen, kind = [], type(spark.range(1))
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, schema, *more, **named: seen.append((f, schema)) or plain(self, f, schema, *more, **named))
    return seen


@pytest.mark.parametrize("stage", ["toxicity", "line_dedup", "ngram_join", "decontaminate"])
def test_stages_give_memory_back(spark, sf_dir, functions, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dict(corpus_pipeline.STAGES)[stage](spark, docs, sf_dir).count()
    assert functions and [s for f, s in functions if f.__qualname__ != "released.<locals>.wrapped"] == []


def test_decontaminate_yields_small_pieces(spark, functions):
    texts = [sentence(i, 200) for i in range(3000)]
    items = spark.createDataFrame([(0, texts[7]), (1, texts[2900])], "item_id long, text string")
    D.drop_leaks(spark.createDataFrame([(0, "")], "doc_id long, text string"), items)
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    got = list(functions[-1][0](iter([batch])))
    assert batch.nbytes > 2 * D.CHUNK and max(b.get_total_buffer_size() for b in got) < 1.5 * D.CHUNK
    assert [i for b in got for i in b.column(0).to_pylist()] == [i for i in range(len(texts)) if i not in (7, 2900)]

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from deltaloom.llm import kernels as K

from .fixtures import TO_LOWER, WORD, shingles

texts = st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab AB\t\n\x0b\x1fé漢\u00a0z"), max_size=40)), max_size=8)


def words(text):
    return WORD.findall((text or "").translate(TO_LOWER))


@given(texts, st.sampled_from([pa.string(), pa.large_string()]), st.integers(1, 60))
@settings(max_examples=200, deadline=None)
def test_words_and_shingles(values, kind, size):
    seen, rows = {}, 0
    for c in K.chunks(pa.array(values, kind), size):
        w = K.words(c)
        sh, bound = K.shingles(w)
        for i in range(len(c.offsets) - 1):
            mine = words(values[c.first + i])
            assert w.bound[i + 1] - w.bound[i] == len(mine)
            for h, x in zip(w.hash[w.bound[i] : w.bound[i + 1]], mine):
                assert seen.setdefault(x, h) == h
            assert len(set(sh[bound[i] : bound[i + 1]].tolist())) == len(shingles(values[c.first + i]))
            rows += 1
    assert rows == len(values) and len(set(map(int, seen.values()))) == len(seen)


def test_pieces_do_not_matter(monkeypatch):
    text = "word " * 300 + "x" * 500 + " tail"
    c = next(K.chunks(pa.array([text])))
    whole = K.words(c).hash
    monkeypatch.setattr(K, "PIECE", 64)
    assert np.array_equal(whole, K.words(c).hash)
    assert np.array_equal(K.hash_prefixes(c.data, *K.spans(c.data, c.offsets, K.NOT_SPACE), (4,))[1][:300], np.full(300, K.words(next(K.chunks(pa.array(["word"])))).hash[0]))


def test_sliced_column():
    a = pa.array(["skip", "a b", None, "c"])[1:]
    assert [len(x) for x in K.words(next(K.chunks(a))).bound[None]] == [4] and K.words(next(K.chunks(a))).bound.tolist() == [0, 2, 2, 3]

"""Benchmark decontamination: every training passage queries a BM25 inverted index of test items.

Index. Test items are cut into words (ASCII letters, digits and everything beyond ASCII; A-Z lower-cased). A posting
is an item and the BM25 impact of a term in it, divided by the item's own full score, so 1 means that a passage has
all of the item's terms, and one threshold serves all items. Postings are in blocks of items with their largest
impacts.

Passages. A document's words are cut in windows of 2s words that start every s words, s being the longest item's
length and 64 at least, so every copy of an item lies whole in some window. Block-max WAND retrieves each item that
scores `threshold` or more. For all windows of a batch at once: the commonest terms whose largest impacts together stay
below the threshold can't make a hit alone, so only blocks of the other terms are looked at, then, where those may do,
the sums of all terms' block maxima; for what is left, posting lists are walked by pivots.

Verification. Runs of `k` words: of the item's, `overlap` must be in the window, and of those of its first half (the
question) and of its second half (the answer) `half_overlap` each. Items of fewer than k words are matched whole.

The index is broadcast in slices of items of at most `slice_bytes`; more items take more passes over the documents. Terms'
weights are of all items, so scores don't hang on the slices.

Null or empty texts, and items without words, match nothing. Null ids pass through. Repeated documents each report
their matches; repeated items report each. Of several windows that match an item the one with the best overlap counts,
then the first. Empty tables give empty results. Documents are read whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import ship

K1, B = 1.2, 0.75
BLOCK_ITEMS = 4
#: Bytes of text and sums of windows that are worked on at once.
CHUNK, CELLS = 1 << 19, 1 << 18
#: An index takes some eight bytes for a byte of text: postings, block maxima and runs.
BYTES_OF_INDEX = 8


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    if len(h) < k:
        return np.empty(0, np.uint64)
    value = np.zeros(len(h) - k + 1, np.uint64)
    for j, p in enumerate(K._place(k)):
        value += h[j : len(h) - k + 1 + j] * p
    return K.mix(value)


class Hit(NamedTuple):
    item: int
    score: float
    overlap: float
    question: float
    answer: float
    at: int


class Weights(NamedTuple):
    """Of all items: known terms in order, how many items have each, the number of items and their average length."""

    terms: np.ndarray
    df: np.ndarray
    items: int
    average: float


def _words_of(texts: list[str | None]) -> list[np.ndarray]:
    out = []
    for c in K.chunks(pa.array(texts, pa.large_string())):
        w = K.words(c, K.WORD_CHAR)
        out += [w.hash[a:b] for a, b in zip(w.bound, w.bound[1:])]
    return out


def weights_of(parts: Iterable[list[str | None]]) -> Weights:
    terms, df, items, total = np.empty(0, np.uint64), np.empty(0, np.int64), 0, 0
    for texts in parts:
        words = _words_of(texts)
        items, total = items + len(words), total + sum(map(len, words))
        every = np.concatenate([terms, *[np.unique(w) for w in words]])
        found, at = np.unique(every, return_inverse=True)
        count = np.ones(len(every), np.int64)
        count[: len(df)] = df
        terms, df = found, np.bincount(at, weights=count, minlength=len(found)).astype(np.int64)
    return Weights(terms, df, items, max(1.0, total / max(1, items)))


def _rows(start: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of some rows of a table in row order, and whose they are (places in `which`)."""
    n = start[which + 1] - start[which]
    of = np.repeat(np.arange(len(which)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + start[which][of], of


class Index:
    """Impact-normalised BM25 postings of some items, with block maxima; both by term, one behind the other."""

    def __init__(self, texts: list[str | None], k: int = 5, weights: Weights | None = None):
        self.k = k
        words = _words_of(texts)
        all_ = weights or weights_of([texts])
        self.runs = [runs(w, min(k, len(w))) if len(w) else np.empty(0, np.uint64) for w in words]
        self.k_of = [min(k, len(w)) for w in words]
        self.longest = max([0, *map(len, words)])
        counted = [np.unique(w, return_counts=True) for w in words]
        length = np.array([len(w) for w in words], np.float64)
        item = np.repeat(np.arange(len(words)), [len(t) for t, _ in counted])
        term = np.concatenate([np.empty(0, np.uint64), *[t for t, _ in counted]])
        tf = np.concatenate([np.empty(0, np.int64), *[n for _, n in counted]]).astype(np.float64)
        df = all_.df[np.searchsorted(all_.terms, term)] if len(term) else np.empty(0)
        impact = np.log1p((all_.items - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / all_.average))
        impact /= np.maximum(np.bincount(item, weights=impact, minlength=len(words)), 1e-12)[item]
        self.terms, of = np.unique(term, return_inverse=True)
        order = np.lexsort((item, of))
        self.item, self.impact = item[order].astype(np.int32), impact[order]
        self.start = np.searchsorted(of[order], np.arange(len(self.terms) + 1))
        self.blocks = max(1, -(-len(words) // BLOCK_ITEMS))
        key = of[order] * self.blocks + self.item // BLOCK_ITEMS
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        self.block = (key[at] % self.blocks).astype(np.int32)
        self.block_max = np.maximum.reduceat(self.impact, at).astype(np.float32) if len(at) else np.empty(0, np.float32)
        self.block_start = np.searchsorted(key[at] // self.blocks, np.arange(len(self.terms) + 1))
        self.most = np.maximum.reduceat(self.block_max, self.block_start[:-1]) if len(at) else np.empty(0, np.float32)
        self.common = np.argsort(np.argsort(-np.diff(self.block_start), kind="stable"))  # a term's place from the commonest
        self.by_common = np.argsort(self.common)
        self.filter = np.zeros(1 << 18, bool)
        self.filter[self._slot(self.terms)] = True

    @property
    def bytes(self) -> int:
        return sum(x.nbytes for x in (self.terms, self.item, self.impact, self.start, self.block, self.block_max, self.block_start, self.most, self.common, self.by_common, *self.runs))

    def _block_max(self, term: int, block: int) -> float:
        a, b = self.block_start[term], self.block_start[term + 1]
        i = a + int(np.searchsorted(self.block[a:b], block))
        return float(self.block_max[i]) if i < b and self.block[i] == block else 0.0

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(46)).astype(np.int64)

    def term_ids(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in h of words that the index knows, and their terms."""
        at = np.flatnonzero(self.filter[self._slot(h)])
        i = np.minimum(np.searchsorted(self.terms, h[at]), max(0, len(self.terms) - 1))
        on = self.terms[i] == h[at] if len(self.terms) else np.zeros(0, bool)
        return at[on], i[on]

    def wand(self, terms: np.ndarray, threshold: float) -> Iterator[tuple[int, float]]:
        """Block-max WAND: (item, score) of every item with a score of threshold or more."""
        slack = threshold * (1 - 1e-6)
        lists = [[0, int(t), self.item[self.start[t] : self.start[t + 1]], self.impact[self.start[t] : self.start[t + 1]]] for t in terms]  # cursor, term, items, impacts
        while lists:
            lists.sort(key=lambda x: x[2][x[0]])
            total, pivot = 0.0, -1
            for p, x in enumerate(lists):
                total += self.most[x[1]]
                if total >= slack:
                    pivot = p
                    break
            if pivot < 0:
                return
            item = int(lists[pivot][2][lists[pivot][0]])
            while pivot + 1 < len(lists) and lists[pivot + 1][2][lists[pivot + 1][0]] == item:
                pivot += 1
            block = item // BLOCK_ITEMS
            if sum(self._block_max(x[1], block) for x in lists[: pivot + 1]) < slack:
                # nothing up to the block's end, or to the next list's item, can reach the threshold
                to = (block + 1) * BLOCK_ITEMS
                if pivot + 1 < len(lists):
                    to = min(to, int(lists[pivot + 1][2][lists[pivot + 1][0]]))
            elif lists[0][2][lists[0][0]] == item:
                score = sum(float(x[3][x[0]]) for x in lists[: pivot + 1])
                if score >= slack:
                    yield item, score
                to = item + 1
            else:
                to = item
            for x in lists[: pivot + 1]:
                if x[2][x[0]] < to:
                    x[0] += int(np.searchsorted(x[2][x[0] :], to))
            lists = [x for x in lists if x[0] < len(x[2])]

    def verify(self, item: int, window: np.ndarray) -> tuple[float, float, float]:
        """Parts of the item's runs, and of its first and second half's, that the window has."""
        mine = self.runs[item]
        there = np.isin(mine, runs(window, self.k_of[item]))
        middle = (len(mine) + 1) // 2
        return float(there.mean()), float(there[:middle].mean()), float(there[middle:].mean()) if len(mine) > 1 else 1.0

    def _bounds(self, term: np.ndarray, of: np.ndarray, windows: int) -> np.ndarray:
        """(window, block) sums of the block maxima of terms; of: each term's window."""
        at, which = _rows(self.block_start, term)
        return np.bincount(of[which] * self.blocks + self.block[at], weights=self.block_max[at], minlength=windows * self.blocks).reshape(windows, self.blocks)

    def _pieces(self, size: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of windows whose entries and whose sums stay within CELLS, or single ones. size: entries of each window."""
        upto, a = np.cumsum(size + self.blocks), 0
        while a < len(size):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + CELLS, "right")))
            yield a, b
            a = b

    def _open_windows(self, term: np.ndarray, first: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
        """Bounds of the windows in which some block's maxima reach the threshold. term: by window, first: where each begins."""
        n = np.diff(np.append(first, len(term)))
        of = np.repeat(np.arange(len(first)), n)
        order = np.lexsort((self.common[term], of))
        term_c = term[order]
        upto = np.cumsum(self.most[term_c], dtype=np.float64)
        upto -= np.repeat(upto[first] - self.most[term_c[first]], n)
        slack = threshold * (1 - 1e-4)
        needed = upto >= slack  # from the first term on with which the threshold could be reached
        spare = np.maximum.reduceat(np.where(needed, 0.0, upto), first)
        length = np.diff(self.block_start)
        term_n, of_n = term_c[needed], of[needed]
        edge = np.searchsorted(of_n, np.arange(len(first) + 1))
        size = np.bincount(of_n, weights=length[term_n], minlength=len(first)).astype(np.int64)
        some = np.zeros(len(first), bool)
        for a, b in self._pieces(size):
            x = slice(edge[a], edge[b])
            if edge[b] > edge[a]:
                sums = self._bounds(term_n[x], of_n[x] - a, b - a)
                some[a:b] = ((sums > 0) & (sums >= (slack - spare[a:b])[:, None])).any(axis=1)
        left = np.flatnonzero(some)
        size = np.bincount(of, weights=length[term], minlength=len(first)).astype(np.int64)[left]
        end = first + n
        for a, b in self._pieces(size):
            at, which = _rows(np.append(first, len(term)), left[a:b])
            open_ = (self._bounds(term[at], which, b - a) >= slack).any(axis=1)
            for i in left[a:b][open_]:
                yield int(first[i]), int(end[i])

    def find(self, w: K.Words, stride: int, threshold: float, overlap: float, half_overlap: float) -> Iterator[tuple[int, Hit]]:
        """(row, best hit) for each pair of a text of the chunk and an item."""
        if not len(self.terms) or not len(w.hash):
            return
        size = np.diff(w.bound)
        per_row = np.maximum(1, -(-size // stride))
        base = np.concatenate([[0], np.cumsum(per_row)])  # segments of `stride` words before each row
        at, term = self.term_ids(w.hash)
        row = np.searchsorted(w.bound, at, "right") - 1
        local = (at - w.bound[row]) // stride
        segment = base[row] + local
        # a window is a segment and the next one; a word is in the window of its segment and of the one before
        inner = local > 0
        window = np.concatenate([segment, segment[inner] - 1])
        key = np.sort(window.astype(np.int64) * len(self.terms) + np.concatenate([term, term[inner]]))
        if not len(key):
            return
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        window, term = key // len(self.terms), key % len(self.terms)
        first = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        found: dict[tuple[int, int], Hit] = {}
        for i, j in self._open_windows(term, first, threshold):
            for item, score in self.wand(term[i:j], threshold):
                r = int(np.searchsorted(base, window[i], "right")) - 1
                begin = int(window[i] - base[r]) * stride
                whole, question, answer = self.verify(item, w.hash[w.bound[r] + begin : min(w.bound[r] + begin + 2 * stride, w.bound[r + 1])])
                if whole >= overlap and min(question, answer) >= half_overlap:
                    if (r, item) not in found or found[r, item].overlap < whole:
                        found[r, item] = Hit(item, score, whole, question, answer, begin)
        for (r, _), hit in found.items():
            yield r, hit


def _slices(items: DataFrame, id_col: str, text_col: str, slice_bytes: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of items whose texts come to slice_bytes / BYTES_OF_INDEX, or of one."""
    ids: list = []
    texts: list = []
    size = 0
    for r in items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        ids.append(r.i)
        texts.append(r.t)
        size += len((r.t or "").encode("utf-8", "surrogatepass"))
        if size * BYTES_OF_INDEX >= slice_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _indexes(items: DataFrame, id_col: str, text_col: str, k: int, slice_bytes: int) -> Iterator[tuple[list, Index]]:
    weights = weights_of(texts for _, texts in _slices(items, id_col, text_col, slice_bytes))
    for ids, texts in _slices(items, id_col, text_col, slice_bytes):
        yield ids, Index(texts, k, weights)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
               k: int = 5, threshold: float = 0.6, overlap: float = 0.8, half_overlap: float = 0.5, slice_bytes: int = 64 << 20) -> DataFrame:
    """(id, item, score, overlap, question, answer, first_word) of every document and test item that it holds."""
    spark = ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type, item_type = src.schema["id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"id {id_type}, item {item_type}, score double, overlap double, question double, answer double, first_word int"
    parts = []
    for ids, index in _indexes(items, item_id, item_text, k, slice_bytes):
        held = spark.sparkContext.broadcast((pa.array(ids), index))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            ids, index = held.value
            stride = max(64, index.longest)
            for batch in batches:
                for c in K.chunks(batch.column(1), CHUNK):
                    hits = list(index.find(K.words(c, K.WORD_CHAR), stride, threshold, overlap, half_overlap))
                    if hits:
                        x = [h for _, h in hits]
                        yield pa.record_batch([
                            batch.column(0).take(pa.array([c.first + r for r, _ in hits])), ids.take(pa.array([h.item for h in x])),
                            pa.array([h.score for h in x]), pa.array([h.overlap for h in x]), pa.array([h.question for h in x]),
                            pa.array([h.answer for h in x]), pa.array([h.at for h in x], pa.int32())],
                            names=["id", "item", "score", "overlap", "question", "answer", "first_word"])

        parts.append(src.mapInArrow(K.released(run), schema))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text: str = "text",
               k: int = 5, threshold: float = 0.6, overlap: float = 0.8, half_overlap: float = 0.5, slice_bytes: int = 64 << 20) -> DataFrame:
    """The rows of docs that hold no test item; one narrow pass for each slice of items, no join."""
    ship(docs.sparkSession)
    for _, index in _indexes(items.withColumn("_i", F.lit(0)), "_i", item_text, k, slice_bytes):
        held = docs.sparkSession.sparkContext.broadcast(index)
        column = docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            stride = max(64, index.longest)
            for batch in batches:
                for c in K.chunks(batch.column(column), CHUNK):
                    keep = np.ones(len(c.offsets) - 1, bool)
                    for r, _ in index.find(K.words(c, K.WORD_CHAR), stride, threshold, overlap, half_overlap):
                        keep[r] = False
                    yield batch.slice(c.first, len(keep)).filter(pa.array(keep))

        docs = docs.mapInArrow(K.released(run), docs.schema)
    return docs

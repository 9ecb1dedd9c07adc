"""Toxicity by maximum-scoring segments of token log-odds, calibrated by extreme-value statistics.

1. Counts. A token (ASCII letters, digits and everything beyond ASCII; A-Z lower-cased) has three features: itself and
   its first 4 and 6 bytes. Features are hashed into tables of fixed size, so the model has the same size for any
   vocabulary. All documents' tokens are counted for the background. A labelled training document counts
   once for each of its features, so that neither long nor repetitive ones dominate.
2. Log-odds. A feature's weight is its log-odds ratio between toxic and clean training text under a Dirichlet prior
   proportional to the background, less `sureness` standard errors, so that rare features weigh little. A token scores
   the best of its features' weights, or 0 if all are negative, less `drift`: chance makes scores fall.
3. Segments. In a text, all maximal segments of the token scores are found in linear time by joining runs around
   positive tokens. Under chance the best segment's score follows an extreme-value law whose location grows with the
   logarithm of the length; its two parameters are fitted to the clean training documents. A segment's expectation is
   the number of its like in a clean text of that length; segments below `expected` are the toxic passages.
4. A logistic curve over the best segment's surprise (-log expectation) and the passages' share turns this into a
   probability; it is fitted to training documents too.

`prior`, `sureness` and `drift`, where not given, are those of GRID with the least logistic loss when each of FOLDS parts of
the training labels is scored by counts of the others; with fewer than MIN_TOXIC toxic labels, the first of GRID.

At most `most_labels` labelled documents (chosen by a hash of the id) train the model, and at most `most_calibration`
of them fit the curves: documented bounds of a broadcast. Rows for which crc32(id as text) mod 3 is 1 never train.

Null or empty texts have no tokens and score as clean. Null ids never train. Several labels of one id: toxic wins;
null labels are ignored. Repeated rows score alike. Without labels everything scores 0. Scoring passes all columns
through and appends its own under names with a leading underscore.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import fresh, partitions, ship

BITS = 18
TABLE = 1 << BITS
PREFIXES = (4, 6)
FEATURES = 1 + len(PREFIXES)
SLICES = 96
LIMIT = 20.0
#: prior, sureness, drift
GRID = [(p, s, d) for p, s in ((10_000.0, 1.64), (1000.0, 1.0), (1000.0, 0.5), (300.0, 1.0), (300.0, 0.5)) for d in (2.0, 2.5)]
FOLDS, MIN_TOXIC = 3, 30


class Model(NamedTuple):
    weight: np.ndarray  # FEATURES * TABLE, float32
    rate: float  # of the extreme-value law
    log_k: float
    curve: np.ndarray  # bias and weights
    drift: float
    expected: float


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(c: K.Chunk) -> tuple[list[np.ndarray], np.ndarray]:
    """Table indexes of each token's features, and the tokens' bounds per text."""
    s, e = K.spans(c.data, c.offsets, K.WORD_CHAR)
    hashes = K.hash_prefixes(c.data, s, e, PREFIXES)
    return [(h >> np.uint64(64 - BITS)).astype(np.int64) + i * TABLE for i, h in enumerate(hashes)], np.searchsorted(s, c.offsets)


def _count(labels):
    """Packed partial counts of a task: slice, background, then toxic and clean of each fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 + 2 * FOLDS, FEATURES * TABLE), np.int64)
        any_rows = False
        for batch in batches:
            any_rows = True
            kind = _labels_of(batch.column(0), labels.value)  # fold * 2, plus 1 for clean
            for c in K.chunks(batch.column(1)):
                index, bound = features(c)
                row = np.repeat(np.arange(c.first, c.first + len(bound) - 1), np.diff(bound))
                known = np.flatnonzero(kind[row] >= 0)
                for x in index:
                    total[0] += np.bincount(x, minlength=total.shape[1])
                    if len(known):  # a labelled text counts once for each of its features
                        pair = np.unique(row[known] * total.shape[1] + x[known])
                        x, of = pair % total.shape[1], kind[pair // total.shape[1]]
                        for k in np.unique(of):
                            total[1 + k] += np.bincount(x[of == k], minlength=total.shape[1])
        if any_rows:
            for i, part in enumerate(np.array_split(np.arange(total.shape[1]), SLICES)):
                a, b = part[0], part[-1] + 1
                width = np.int32 if total[:, a:b].max(initial=0) < 2**31 else np.int64
                yield pa.record_batch([pa.array([i], pa.int32()), pa.array([np.dtype(width).itemsize], pa.int32()), pa.array([total[:, a:b].astype(width).tobytes()], pa.binary())], names=["slice", "width", "counts"])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for i, w, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            value = np.frombuffer(x.as_py(), np.int32 if w == 4 else np.int64)
            if i in sums:
                sums[i] += value
            else:
                sums[i] = value.astype(np.int64)
    for i, x in sums.items():
        yield pa.record_batch([pa.array([i], pa.int32()), pa.array([8], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["slice", "width", "counts"])


def _labels_of(ids: pa.Array, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """1, 0, or -1 where there is no training label."""
    keys, toxic = known
    x = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(keys):
        return np.full(len(x), -1)
    i = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    out = np.where(keys[i] == x, toxic[i], -1)
    if ids.null_count:
        out[ids.is_null().to_numpy(zero_copy_only=False)] = -1
    return out


def log_odds(counts: np.ndarray, prior: float, sureness: float) -> np.ndarray:
    """Lower bounds of the log-odds ratios (toxic to clean) with a Dirichlet prior along the background."""
    out = np.empty(counts.shape[1], np.float32)
    for i in range(FEATURES):
        all_, toxic, clean = counts[:, i * TABLE : (i + 1) * TABLE].astype(np.float64)
        a = prior * (all_ + 1e-3) / max(1.0, all_.sum() + 1e-3 * TABLE)
        nt, nc = toxic.sum() + prior, clean.sum() + prior
        delta = np.log((toxic + a) / (nt - toxic - a)) - np.log((clean + a) / (nc - clean - a))
        out[i * TABLE : (i + 1) * TABLE] = delta - sureness * np.sqrt(1 / (toxic + a) + 1 / (clean + a))
    return out


def segments(start: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, in linear time: (first token, tokens, score).

    start: positions of the positive tokens; low and high: the text's running total before and after each.
    """
    stack: list[list] = []  # first, last, total before, total after, index of the last one with a lower total before
    for p, a, b in zip(start.tolist(), low.tolist(), high.tolist()):
        now = [p, p, a, b, -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= now[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= now[3]:
                now[4] = j
                stack.append(now)
                break
            now = [stack[j][0], p, stack[j][2], now[3], -1]
            del stack[j:]
    return [(s[0], s[1] - s[0] + 1, s[3] - s[2]) for s in stack]


def scan(c: K.Chunk, weight: np.ndarray, drift: float) -> tuple[np.ndarray, dict[int, list[tuple[int, int, float]]]]:
    """Tokens per text, and the maximal segments of the texts that have any."""
    index, bound = features(c)
    score = weight[index[0]]
    for x in index[1:]:
        np.maximum(score, weight[x], out=score)
    score = np.maximum(score, 0).astype(np.float64) - drift
    total = np.concatenate([[0.0], np.cumsum(score)])
    at = np.flatnonzero(score > 0)
    row = np.searchsorted(bound, at, "right") - 1
    out = {}
    edge = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else []
    for i, j in zip(edge, np.append(edge[1:], len(row)) if len(row) else []):
        p = at[i:j]
        r = int(row[i])
        out[r] = segments(p - bound[r], total[p], total[p + 1])
    return np.diff(bound), out


def surprise(best: np.ndarray, n: np.ndarray, rate: float, log_k: float) -> np.ndarray:
    """-log of the expected number of segments as good as that in a clean text of n tokens."""
    return rate * best - log_k - np.log(np.maximum(n, 1))


def fit_extremes(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Rate and log K of the law of best segment scores in clean texts, by moments, length taken out."""
    rate = 1.0
    if len(best) < 2:
        return rate, 0.0
    for _ in range(30):
        u = best - np.log(np.maximum(n, 1)) / rate
        rate = float(np.clip(np.pi / (np.sqrt(6) * max(u.std(), 1e-6)), 0.2, 5.0))
    u = best - np.log(np.maximum(n, 1)) / rate
    return rate, float(rate * u.mean() - np.euler_gamma)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the ridge keeps separable data finite."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


def evidence(n: np.ndarray, found: list[list[tuple[int, int, float]]], rate: float, log_k: float, expected: float) -> np.ndarray:
    """Two numbers per text: the best segment's surprise, bounded, and how many passages are significant (log)."""
    best = np.array([max((s for _, _, s in x), default=0.0) for x in found])
    limit = -np.log(expected)
    many = np.array([sum(float(surprise(np.array(s), np.array(m), rate, log_k)) > limit for _, _, s in x) for x, m in zip(found, n)])
    least = np.where(best > 0, surprise(best, n, rate, log_k), -LIMIT)  # no segment at all: nothing to be surprised by
    return np.column_stack([np.clip(least, -LIMIT, LIMIT), np.log1p(many)])


def _pooled(counts: np.ndarray, leave: int | None = None) -> np.ndarray:
    """Background, toxic, clean: of all folds, or of all but one."""
    on = [i for i in range(FOLDS) if i != leave]
    return np.stack([counts[0], sum(counts[1 + 2 * i] for i in on), sum(counts[2 + 2 * i] for i in on)])


def _scanned(src: DataFrame, known: tuple[np.ndarray, ...], weights: list[list[np.ndarray]], settings: list[tuple[int, float]]):
    """t, n and s of each known document under each setting g: (index into weights, drift). weights: by the document's fold."""
    held = src.sparkSession.sparkContext.broadcast((known, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (k, t, fold), weights = held.value
        for batch in batches:
            toxic, part = _labels_of(batch.column(0), (k, t)), _labels_of(batch.column(0), (k, fold))
            for p in range(FOLDS):
                on = (toxic >= 0) & (part == p)
                y = toxic[on]
                for c in K.chunks(batch.column(1).filter(pa.array(on))):
                    for g, (w, drift) in enumerate(settings):
                        n, found = scan(c, weights[w][p], drift)
                        yield pa.record_batch([pa.array(np.full(len(n), g, np.int32)), pa.array(y[c.first : c.first + len(n)].astype(np.int32)), pa.array(n.astype(np.int64)),
                                               pa.array([[s for _, _, s in found.get(i, [])] for i in range(len(n))], pa.list_(pa.float64()))], names=["g", "t", "n", "s"])

    return src.mapInArrow(K.released(run), "g int, t int, n long, s array<double>").toArrow()


def _calibrate(sample, expected: float) -> tuple[tuple[float, float, np.ndarray], float]:
    """Rate, log K and curve fitted to a sample, and the logistic loss there."""
    sample = sample.sort_values(["t", "n"], kind="stable")
    y, n = sample["t"].to_numpy(), sample["n"].to_numpy()
    found = [[(0, 0, float(v)) for v in x] for x in sample["s"]]
    best = np.array([max((s for _, _, s in x), default=0.0) for x in found])
    rate, log_k = fit_extremes(np.sort(best[y == 0]), n[y == 0][np.argsort(best[y == 0], kind="stable")])
    x = evidence(n, found, rate, log_k, expected)
    curve = fit_curve(x, y)
    z = np.clip(curve[0] + x @ curve[1:], -14, 14)
    return (rate, log_k, curve), float(np.mean(np.logaddexp(0, z) - y * z))


def _losses(src: DataFrame, known: tuple[np.ndarray, ...], weights: list[list[np.ndarray]], settings: list[tuple[int, float]], expected: float) -> list[float]:
    sample = _scanned(src, known, weights, settings)
    return [_calibrate(sample.filter(pc.equal(sample["g"], g)).to_pandas(), expected)[1] for g in range(len(settings))] if len(sample) else [0.0]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic",
          most_labels: int = 1_000_000, most_calibration: int = 100_000, prior: float | None = None, sureness: float | None = None, drift: float | None = None, expected: float = 0.01) -> Model:
    spark = ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    usable = (
        labels.select(F.col(label_id).cast("long").alias("id"), F.col(label_col).alias("t")).where(F.col("id").isNotNull() & F.col("t").isNotNull())
        .where(~is_held_out(F.col("id"))).groupBy("id").agg(F.max("t").cast("int").alias("t"))
    )
    many = usable.count()
    if many > most_labels:
        usable = usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * most_labels / many))
    got = usable.toPandas().sort_values("id")
    keys, toxic = got["id"].to_numpy(np.int64), got["t"].to_numpy(np.int64)
    fold = (K.mix(keys.view(np.uint64) ^ np.uint64(0x5DEECE66D)) % np.uint64(FOLDS)).astype(np.int64)
    held = spark.sparkContext.broadcast((keys, 2 * fold + 1 - toxic))
    counts = np.zeros((1 + 2 * FOLDS, FEATURES * TABLE), np.int64)
    rows = (
        src.mapInArrow(K.released(_count(held)), "slice int, width int, counts binary")
        .repartition(min(SLICES, partitions(spark)), "slice").mapInArrow(K.released(_add), "slice int, width int, counts binary")
    )
    at = np.array_split(np.arange(counts.shape[1]), SLICES)
    for r in rows.toLocalIterator():
        part = at[r["slice"]]
        counts[:, part] += np.frombuffer(r["counts"], np.int64).reshape(len(counts), -1)
    grid = list(dict.fromkeys(tuple(x if given is None else given for given, x in zip((prior, sureness, drift), g)) for g in GRID))
    if not len(keys) or not toxic.any():
        return Model(np.full(counts.shape[1], -grid[0][2], np.float32), 1.0, 0.0, np.array([-30.0, 0.0, 0.0]), grid[0][2], expected)

    # calibration documents: a bounded, hash-chosen part of the training labels
    pick = K.mix(keys.view(np.uint64)) < np.uint64(min((1 << 64) - 1, int((1 << 64) * most_calibration / max(1, len(keys)))))
    known = keys[pick], toxic[pick], fold[pick]
    if len(grid) > 1 and toxic.sum() >= MIN_TOXIC:
        kinds = list(dict.fromkeys(g[:2] for g in grid))
        weights = [[log_odds(_pooled(counts, leave), *k) for leave in range(FOLDS)] for k in kinds]
        losses = _losses(src, known, weights, [(kinds.index(g[:2]), g[2]) for g in grid], expected)
        grid = [grid[int(np.argmin(np.round(losses, 6)))]]
    prior, sureness, drift = grid[0]
    weight = log_odds(_pooled(counts), prior, sureness)
    sample = _scanned(src, known, [[weight] * FOLDS], [(0, drift)]).to_pandas()
    if not len(sample):
        return Model(weight, 1.0, 0.0, np.array([-30.0, 0.0, 0.0]), drift, expected)
    return Model(weight, *_calibrate(sample, expected)[0], drift, expected)


PASSAGES = "array<struct<first_token:int,tokens:int,score:double>>"


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with _score and _passages, the significant segments of each text; more underscores where docs has such columns."""
    held = ship(docs.sparkSession).sparkContext.broadcast(model)
    column = docs.columns.index(text_col)
    kind = pa.list_(pa.struct([("first_token", pa.int32()), ("tokens", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        limit = -np.log(m.expected)
        for batch in batches:
            value, passages = np.zeros(batch.num_rows), []
            for c in K.chunks(batch.column(column)):
                n, by_row = scan(c, m.weight, m.drift)
                found = [by_row.get(i, []) for i in range(len(n))]
                x = evidence(n, found, m.rate, m.log_k, m.expected)
                value[c.first : c.first + len(n)] = 1 / (1 + np.exp(-np.clip(m.curve[0] + x @ m.curve[1:], -30, 30)))
                passages += [[s for s in f if m.rate * s[2] - m.log_k - np.log(max(k, 1)) > limit] for f, k in zip(found, n)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value), pa.array([[dict(zip(("first_token", "tokens", "score"), s)) for s in p] for p in passages], kind)],
                                             names=[*[f"c{i}" for i in range(batch.num_columns)], "_score", "_passages"])

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    return plain.mapInArrow(K.released(run), f"{fields}, _score double, _passages {PASSAGES}").toDF(*docs.columns, fresh(docs.columns, "_score"), fresh(docs.columns, "_passages"))

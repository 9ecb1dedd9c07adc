"""Toxicity with the settings a query uses: chosen by the training labels."""

import zlib

import numpy as np

from deltaloom.llm import toxicity

from .fixtures import sentence


def test_rare_words_are_learnt(spark):
    # each toxic text has words of a family that few labels have: the fixed settings caught few of them
    docs, labels = [], []
    for i in range(600):
        w = sentence(i, 60).split(" ")
        if i % 6 == 0:
            for k in range(3):
                w.insert((i * 7 + 11 * k) % len(w), ("bomente", "achlich", "reeux")[i // 6 % 3] + "abcdefgh"[(i + k) % 8])
        docs.append(" ".join(w))
        labels.append(int(i % 6 == 0))
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]

    def caught(**fixed):
        got = {r.doc_id: r._score >= 0.7 for r in toxicity.score(d, toxicity.train(d, lab, **fixed)).collect()}
        toxic = [i for i in held if labels[i]]
        return sum(got[i] for i in toxic) / len(toxic), sum(got[i] for i in held if not labels[i])

    assert caught(prior=10_000.0, sureness=1.64, drift=2.0)[0] < 0.5
    recall, wrong = caught()
    assert recall >= 0.9 and wrong <= 5


def test_model_against_plain_counts(spark):
    """Counts, weights, segments and the extreme-value law, each stated once more without arrays of texts."""
    import math
    import re
    import zlib

    import pyarrow as pa

    from deltaloom.llm import kernels as K

    rng = np.random.default_rng(8)
    common, bad = [f"word{i}" for i in range(40)], ["vilething", "vilely", "Crudeness"]
    rows = []
    for i in range(90):
        words = list(rng.choice(common, rng.integers(5, 60)))
        if i % 4 == 0:
            words[2:2] = list(rng.choice(bad, 3))
        rows.append((i, " ".join(words) if i != 7 else None, int(i % 4 == 0) if i % 10 else None))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    prior, sureness, drift = 60.0, 0.7, 0.4
    model = toxicity.train(docs, labels, prior=prior, sureness=sureness, drift=drift)

    def features(word):
        data = np.frombuffer(word.lower().encode(), np.uint8)
        h = K.hash_prefixes(data, np.array([0]), np.array([len(data)]), toxicity.PREFIXES)
        return [(int(x[0]) >> 64 - toxicity.BITS) + i * toxicity.TABLE for i, x in enumerate(h)]

    tokens = {i: re.findall("[0-9A-Za-z]+", t or "") for i, t, _ in rows}
    seen, per_class = {}, {0: {}, 1: {}}
    known = [(i, y) for i, _, y in rows if y is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    for i in tokens:
        for w in tokens[i]:
            for f in features(w):
                seen[f] = seen.get(f, 0) + 1
    for i, y in known:
        for f in {f for w in tokens[i] for f in features(w)}:
            per_class[y][f] = per_class[y].get(f, 0) + 1
    weight = {}
    for f in seen:
        table = range(f // toxicity.TABLE * toxicity.TABLE, (f // toxicity.TABLE + 1) * toxicity.TABLE)
        total = sum(n for g, n in seen.items() if g in table)
        a = prior * (seen[f] + 1e-3) / (total + 1e-3 * toxicity.TABLE)
        t, c = per_class[1].get(f, 0) + a, per_class[0].get(f, 0) + a
        nt, nc = (sum(n for g, n in per_class[y].items() if g in table) + prior for y in (1, 0))
        weight[f] = math.log(t / (nt - t)) - math.log(c / (nc - c)) - sureness * math.sqrt(1 / t + 1 / c)
    for f, w in weight.items():
        assert abs(model.weight[f] - w) < 1e-4
    best = {}
    for i, _ in known:
        score = [max(0.0, max(weight[f] for f in features(w))) - drift for w in tokens[i]]
        best[i] = max([0.0, *[sum(score[a:b]) for a in range(len(score)) for b in range(a + 1, len(score) + 1)]])
    clean = [i for i, y in known if not y]
    u = np.array([best[i] - math.log(max(1, len(tokens[i]))) / model.rate for i in clean])
    assert abs(model.rate - np.clip(math.pi / (math.sqrt(6) * u.std()), 0.2, 5.0)) < 1e-3
    assert abs(model.log_k - (model.rate * u.mean() - np.euler_gamma)) < 1e-3
    scored = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for i in best:
        law = [math.exp(-(model.rate * s.score - model.log_k - math.log(max(1, len(tokens[i]))))) for s in scored[i]._passages]
        assert all(e < model.expected for e in law)
        assert not scored[i]._passages or abs(max(s.score for s in scored[i]._passages) - best[i]) < 1e-3
    by_class = [np.mean([scored[i]._score for i, y in known if y == k]) for k in (0, 1)]
    assert by_class[0] < 0.3 and by_class[1] > 0.7
    odd = toxicity.score(spark.createDataFrame([(1, None, 5), (1, None, 5), (2, "vilething " * 100_000, 6)], "doc_id long, text string, _score int"), model)
    assert odd.columns == ["doc_id", "text", "_score", "__score", "_passages"]
    got = odd.collect()
    assert [r._score for r in got] == [5, 5, 6] and got[0].__getitem__("__score") == got[1].__getitem__("__score") < 0.5

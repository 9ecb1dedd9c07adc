"""N-gram Jaccard self-join of documents: rare-first prefix filtering, verified once per pair.

Two documents link when the Jaccard similarity of their sets of distinct `k`-word shingles is at least num/den.

1. `members`: each document's set size and class. Documents with equal sets are one class (64-bit hash of the set).
   From here on there is one entry per class, however many copies it has.
2. Frequencies. Shingles go to partitions by hash, in packed blocks; a shingle found in one class only can't be
   shared, so what comes back are those of two and more, with their frequency. A class keeps them in rare-first
   order, its unshared shingles counting as the first ones. A class whose shared part is below num/den of its set
   can have no partner and goes. Shingles of more than `hot` of all classes (a passage that everybody quotes) are
   found beforehand by counting within blocks; they are at most shingles-per-document/(hot/2), which bounds their
   broadcast; they stay with their documents, are the last in order, and no task gathers their owners.
3. Candidates. The prefix of a set of n is its first n - ceil(n*num/den) + 1 shingles: any two that link share one
   there. Within the classes that share a prefix shingle, first each is paired with the most central one (fewest
   unshared shingles). Length, positional and suffix filters drop pairs that can't reach the threshold: sizes alone;
   what is left behind the shared position; and the least common counts of eight hash ranges of both sets.
4. Verification, once per distinct pair, by intersecting whole sets. The links found join classes to components; then
   within each prefix shingle's group only pairs across different components remain to be tried, those outside the
   central one's component against all. So a group of thousands of near copies costs about one pair a copy, and yet
   no link between different components is missed.

Shingles are compared by 64-bit hashes. Null or empty texts and those without words have an empty set, link with
nothing and are their own component; texts of fewer than k words have their whole sequence as only shingle. Null ids
are allowed: a component's id is its smallest non-null id. Repeated rows are copies like others. Empty tables give
empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from . import packing as P
from .components import components
from .shared import cut, partitions, ship

BLOCK_VALUES = 1 << 19
VALUES_PER_PART = 4_000_000
HOT_WEIGHT = 1 << 30
SALTS = 32


class Joined(NamedTuple):
    """members: id, n, cls. links: a, b (verified pairs of classes). result: id, n_shingles, component_id."""

    members: DataFrame
    links: DataFrame
    result: DataFrame


def class_of(values: np.ndarray) -> int:
    """Hash of a set of hashes, as a signed 64-bit number."""
    total = (int(K.mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) + len(values)) & K._M64
    return int(K.mix(np.array([total], np.uint64)).view(np.int64)[0])


class _Block:
    """Sets of some distinct classes, up to a bounded number of values."""

    def __init__(self) -> None:
        self.sets: dict[int, np.ndarray] = {}
        self.total = 0

    def add(self, cls: int, values: np.ndarray) -> bool:
        if cls not in self.sets:
            self.sets[cls] = values
            self.total += len(values)
        return self.total >= BLOCK_VALUES or len(self.sets) >= 60_000

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in self.sets.values()], np.int32)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return np.array(list(self.sets), np.int64), sizes, owner, np.concatenate(list(self.sets.values()))


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    for c in K.chunks(column):
        values, bound = K.shingles(K.words(c), k)
        for i, x in K.per_text(values, bound):
            yield c.first + i, x


def _members(k: int, hot: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()

        def frequent(id_type) -> Iterator[pa.RecordBatch]:
            _, sizes, _, values = block.arrays()
            v = np.sort(values)
            at = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
            n = np.diff(np.append(at, len(v)))
            on = n >= max(2, hot / 2 * len(sizes))
            yield pa.record_batch([pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                                   pa.array([v[at[on]].tobytes()], pa.binary()), pa.array([n[on].astype(np.int64).tobytes()], pa.binary())],
                                  names=["id", "n", "cls", "value", "times"])

        id_type = pa.int64()
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            id_type = ids.type
            n, cls = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            for i, x in _sets(text, k):
                n[i], cls[i] = len(x), class_of(x)
                if block.add(int(cls[i]), x):
                    yield from frequent(id_type)
                    block = _Block()
            none = pa.nulls(len(ids), pa.binary())
            yield pa.record_batch([ids, pa.array(n), pa.array(cls, mask=n == 0), none, none], names=["id", "n", "cls", "value", "times"])
        if block.sets:
            yield from frequent(id_type)

    return run


def _unpack_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for v, t in zip(b.column(0), b.column(1)):
            yield pa.record_batch([pa.array(np.frombuffer(v.as_py(), np.int64)), pa.array(np.frombuffer(t.as_py(), np.int64))], names=["value", "times"])


def _find(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of each x in sorted_values, or -1."""
    if not len(sorted_values):
        return np.full(len(x), -1)
    i = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return np.where(sorted_values[i] == x, i, -1)


def _scatter(k: int, parts: int, hot):
    """Shingles to the partition of their hash; hot ones, with their rank, to that of their class."""

    def flush(block: _Block) -> Iterator[pa.RecordBatch]:
        owners, sizes, owner, values = block.arrays()
        known, times = hot.value
        at = _find(known, values)
        cold = at < 0
        yield from P.pack(P.part_of(values[cold], parts), owner[cold], owners, sizes, values[cold])
        at, owner, values = at[~cold], owner[~cold], values[~cold]
        yield from P.pack(P.part_of(owners, parts)[owner], owner, owners, sizes, values, times[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            for _, x in _sets(batch.column(0), k):
                if block.add(class_of(x), x):
                    yield from flush(block)
                    block = _Block()
        if block.sets:
            yield from flush(block)

    return run


def _shared(parts: int):
    """Keep the shingles of two classes and more, and send them to their classes' partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cold = []
        for b in batches:
            forward = b.column("weight").is_valid()
            if any(forward.to_pylist()):
                yield b.filter(forward)
            cold.append(b.filter(b.column("weight").is_null()))
        if not cold:
            return
        owner, size, value, _ = P.unpack(cold)
        del cold
        order = np.argsort(value)
        v = value[order]
        same = v[1:] == v[:-1]
        twice = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(v) else order
        owner, size, value = owner[twice], size[twice], value[twice]
        order = np.lexsort((owner, value))
        owner, size, value = owner[order], size[order], value[order]
        if not len(value):
            return
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])])
        owner, size, value = owner[new], size[new], value[new]
        at = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        times = np.diff(np.append(at, len(value)))
        df = np.repeat(times, times).astype(np.int32)
        on = df > 1
        owner, size, value, df = owner[on], size[on], value[on], np.minimum(df[on], HOT_WEIGHT - 1)
        order = np.argsort(owner, kind="stable")
        owner, size, value, df = owner[order], size[order], value[order], df[order]
        if not len(owner):
            return
        at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        index = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(owner))))
        yield from P.pack(P.part_of(owner, parts), index, owner[at], size[at], value, df)

    return run


_SET = pa.schema([("cls", pa.int64()), ("n", pa.int32()), ("u", pa.int32()), ("sh", pa.list_(pa.int64())), ("sig", pa.list_(pa.int32()))])
SET_SCHEMA = "cls long, n int, u int, sh array<long>, sig array<int>"


def _ordered(num: int, den: int):
    """A class's shared shingles, rare first, if they are enough for a partner; u: how many it shares with none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not got:
            return
        owner, size, value, df = P.unpack(got)
        del got
        order = np.lexsort((value, df, owner))
        owner, size, value = owner[order], size[order], value[order]
        if not len(owner):
            return
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])])
        owner, size, value = owner[new], size[new], value[new]
        at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        m, n = np.diff(np.append(at, len(owner))), size[at].astype(np.int64)
        row = np.repeat(np.arange(len(at)), m)
        sig = np.bincount(row * 8 + (value >> np.uint64(8) & np.uint64(7)).astype(np.int64), minlength=8 * len(at)).reshape(-1, 8)
        for a in range(0, len(at), 5000):
            rows = [i for i in range(a, min(a + 5000, len(at))) if m[i] * den >= n[i] * num]
            if rows:
                yield pa.record_batch([
                    pa.array(owner[at[rows]]), pa.array(n[rows].astype(np.int32)), pa.array((n[rows] - m[rows]).astype(np.int32)),
                    pa.array([value[at[i] : at[i] + m[i]].view(np.int64) for i in rows], pa.list_(pa.int64())),
                    pa.array(list(sig[rows].astype(np.int32)), pa.list_(pa.int32()))], schema=_SET)

    return run


def _may_reach(num: int, den: int, x: str, y: str) -> Column:
    """Length, positional and suffix filters for entries x and y (structs) that share a prefix shingle."""
    def c(s: str, f: str) -> Column:
        return F.col(f"{s}.{f}")

    def enough(common: Column) -> Column:
        return (den + num) * common.cast("long") >= num * (c(x, "n") + c(y, "n")).cast("long")

    length = (den * F.least(c(x, "n"), c(y, "n")).cast("long") >= num * F.greatest(c(x, "n"), c(y, "n")).cast("long"))
    position = F.least(c(x, "pos"), c(y, "pos")) + 1 + F.least(c(x, "n") - c(x, "pos"), c(y, "n") - c(y, "pos")) - 1
    suffix = F.aggregate(F.zip_with(c(x, "sig"), c(y, "sig"), lambda p, q: F.least(p, q)), F.lit(0), lambda s, v: s + v)
    return length & enough(position) & enough(suffix)


def _pairs(df: DataFrame, num: int, den: int) -> DataFrame:
    return (
        df.where(_may_reach(num, den, "x", "y"))
        .select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()
    )


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    left = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sh").alias("sa"))
    right = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sh").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", common.alias("o"))
        .where(F.col("o") * (den + num) >= (F.col("na") + F.col("nb")).cast("long") * num).select("a", "b")
    )


def _spread(labelled: DataFrame, *more: str) -> DataFrame:
    """A row for each prefix shingle h of a class, with the class's entry y and the columns `more`."""
    return labelled.select(*more, "cls", "n", "u", "sig", F.posexplode("pre").alias("_i", "h")).select(
        "h", *more, F.struct("u", "cls", "n", (F.col("u") + F.col("_i")).alias("pos"), "sig").alias("y"))


def link(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Verified pairs of classes whose components are those of all links; see the module's text."""
    need = F.floor((F.col("n").cast("long") * num + den - 1) / den).cast("int")
    prefix = F.col("n") - need + 1 - F.col("u")
    classes = sets.where(prefix > 0).select("cls", "n", "u", "sig", F.slice("sh", F.lit(1), prefix).alias("pre"))
    rows = cut(_spread(classes))
    centre = rows.groupBy("h").agg(F.min("y").alias("x"), F.count("*").alias("_c")).where("_c > 1").drop("_c")
    tried = cut(_pairs(rows.join(centre, "h").where(F.col("x.cls") != F.col("y.cls")), num, den))
    star = cut(verify(tried, sets, num, den))
    # a class gets its label before its shingles are spread, so that a long one's don't all meet it in one task
    labelled = classes.join(components(star).hint("merge"), F.col("cls") == F.col("node"), "left").withColumn("label", F.coalesce("label", "cls"))
    now = cut(_spread(labelled, "label"))
    mixed = (
        now.groupBy("h").agg(F.min_by("label", "y").alias("main"), F.min("label").alias("_a"), F.max("label").alias("_b"))
        .where("_a != _b").select("h", "main")
    )
    met = cut(now.join(mixed, "h"))
    # the prefixes of the classes that are still open, for each of their rows, of which a class may have many
    prefixes = classes.join(met.select(F.col("y.cls").alias("_c")).distinct(), F.col("cls") == F.col("_c")).select("_c", "pre", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    open_rows = cut(met.join(prefixes, (F.col("y.cls") == F.col("_c")) & (F.pmod(F.col("y.pos"), F.lit(SALTS)) == F.col("_s"))).drop("_c", "_s"))
    aside = open_rows.where("label != main").select("h", F.col("y").alias("x"), F.col("label").alias("xl"), F.col("pre").alias("xpre"))
    # of the prefix shingles that a pair shares, only the first brings it up
    across = open_rows.join(aside, "h").where(
        (F.col("label") != F.col("xl")) & ((F.col("label") == F.col("main")) | (F.col("x.cls") < F.col("y.cls")))
        & _may_reach(num, den, "x", "y") & (F.get(F.array_intersect("pre", "xpre"), F.lit(0)) == F.col("h")))
    rest = _pairs(across, num, den).join(tried, ["a", "b"], "left_anti")
    return star.unionByName(cut(verify(rest, sets, num, den)))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100, hot: float = 0.01, most_hot: int = 4_000_000) -> Joined:
    """Self-join at a Jaccard similarity of num/den; see the module's text.

    `most_hot` bounds the broadcast (8 bytes each); were there more, the most frequent are treated as hot. What counts
    as hot changes the order of shingles and so the cost, never the result.
    """
    spark = ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    first = cut(src.mapInArrow(K.released(_members(k, hot)), f"id {id_type}, n long, cls long, value binary, times binary"))
    members = first.where("value is null").select("id", "n", "cls")
    count, total = members.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = (
        first.where("value is not null").select("value", "times").mapInArrow(K.released(_unpack_hot), "value long, times long")
        .groupBy("value").agg(F.sum("times").alias("times")).where(F.col("times") >= max(64, hot * count))
        .orderBy(F.desc("times"), "value").limit(most_hot).toPandas()
    )
    known = found["value"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    times = np.minimum(found["times"].to_numpy(np.int64), HOT_WEIGHT - 1).astype(np.int32) + np.int32(HOT_WEIGHT)
    held = spark.sparkContext.broadcast((known[order], times[order]))
    parts = partitions(spark, -(-int(total) // VALUES_PER_PART))
    sets = cut(
        src.select("text").mapInArrow(K.released(_scatter(k, parts, held)), P.SCHEMA).repartitionById(parts, F.col("part"))
        .mapInArrow(K.released(_shared(parts)), P.SCHEMA).repartitionById(parts, F.col("part"))
        .mapInArrow(K.released(_ordered(num, den)), SET_SCHEMA)
    )
    links = link(sets, num, den)
    labels = components(links)
    mins = members.where("n > 0").groupBy("cls").agg(F.min("id").alias("first"))
    linked = mins.join(labels, F.col("cls") == F.col("node"))
    least = linked.groupBy("label").agg(F.min("first").alias("least"))
    salted = least.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # a large component's classes meet its id in SALTS tasks
    of_class = linked.withColumn("_salt", F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int")).join(salted, ["label", "_salt"]).select(F.col("node").alias("_n"), "least")
    ids = cut(mins.join(of_class, F.col("cls") == F.col("_n"), "left").select(F.col("cls").alias("_c"), F.coalesce("least", "first").alias("component_id")))
    full = members.where("n > 0").join(ids, F.col("cls") == F.col("_c")).select("id", F.col("n").alias("n_shingles"), "component_id")
    bare = members.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return Joined(members, links, full.unionByName(bare))

"""Fuzzy line deduplication: SimHash of normalised lines, pigeonhole blocks, verified edit similarity.

A line is what stands between newlines. Its normal form is its words (ASCII letters, digits and everything beyond
ASCII; other ASCII characters separate), A-Z lower-cased, digits written 0, one space between words. Lines without words
always stay.

1. Each line gets a key, the 64-bit hash of its normal form. Lines of equal keys are one node from here on,
   pre-aggregated before the shuffle, with their first occurrence. Lines of `min_words` words or MIN_CHARS characters (as in
   scripts without spaces) also get a SimHash; shorter ones are compared by their keys only.
2. SimHashes that agree in three of ten blocks meet, and are candidates if at most 13 bits differ (`line_simhash`). Of
   those that meet, a spanning forest goes on: thousands of near copies need not be paired with each other.
3. Candidates are verified by the edit distance of their normal forms (`edits`): similarity 1 - distance/longer at least 0.9.
   Where a pair of the forest fails, its group is met again, and pairs across its components are verified, the closest
   of each line first, so that a large group of loose copies mostly hangs together before all that are left are tried,
   each once, where they meet, so that those that fail are no rows: no link between candidates of different components
   is lost.
4. Verified pairs join nodes to connected groups; of each group the occurrence with the least (id, row, line) stays.

With `grams`, candidates come from `line_grams` in place of 2: more sensitive to edits all over a line, at many times the cost.

Null or empty texts have no lines to remove and stay as they are. Null ids sort first. Repeated rows (equal id and
text) count as one row: what one keeps, the others keep. Ties are broken by id, then the row's hash, then the line.
Empty tables give empty results. Other columns pass through, whatever their names; see `fresh` for the appended ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import edits as E
from . import kernels as K
from . import line_grams as G
from . import line_simhash as S
from . import packing as P
from .components import components
from .shared import cut, free_shuffles, fresh, join_few, partitions, ship, small

VALUES_PER_PART, VALUES_A_ROUND, TEXTS_A_ROUND = 4_000_000, 500_000, 20_000
EDGES_PER_TASK = 2_000_000
#: Of each line's near ones in other components so many closest are tried, then more of those still apart, then all.
CLOSEST = (4, None)
CHUNK = 1 << 19


def _lines(min_words: int, hashed: bool):
    """Rows (id, rid, text) to their lines that have words, with keys, and SimHashes of those long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in K.chunks(batch.column(2), CHUNK):
                row, number, words, text, start, end = G.normal_lines(c)
                h = K.hash_ranges(text, start, end)
                on = G.enough(words, G.characters(text, start, end), min_words) & hashed
                s, x = np.zeros(len(h), np.uint64), np.zeros(len(h), np.int32)
                if on.any():
                    s[on], x[on] = S.simhashes(text, start[on], end[on])
                take = pa.array(row + c.first)
                yield pa.record_batch([batch.column(0).take(take), batch.column(1).take(take), pa.array(number.astype(np.int32)),
                                       pa.array(h.view(np.int64)), pa.array(s.view(np.int64), mask=~on), pa.array(x, mask=~on)],
                                      names=["id", "rid", "line", "h", "s", "x"])

    return run


def _wanted_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, keys) to the normal forms of the lines that have those keys, once for each row."""
    for batch in batches:
        for c in K.chunks(batch.column(0), CHUNK):
            row, _, _, text, start, end = G.normal_lines(c)
            h = K.hash_ranges(text, start, end)
            wanted = batch.column(1).slice(c.first, len(c.offsets) - 1)
            key, owner = wanted.flatten().to_numpy().view(np.uint64), np.repeat(np.arange(len(wanted)), wanted.value_lengths().to_numpy())
            ours = np.sort(K.mix(key) ^ owner.astype(np.uint64))
            of_line = K.mix(h) ^ row.astype(np.uint64)
            at = np.flatnonzero(ours[np.minimum(np.searchsorted(ours, of_line), max(0, len(ours) - 1))] == of_line) if len(ours) else np.empty(0, np.int64)
            _, first = np.unique(of_line[at], return_index=True)
            at = at[first]
            yield pa.record_batch([pa.array(h[at].view(np.int64)), pa.array([text[i:j].tobytes() for i, j in zip(start[at], end[at])], pa.binary()).cast(pa.string())], names=["h", "t"])


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _check(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), pa.array(E.distances(b.column(2), b.column(3), similarity) >= 0)], names=["a", "b", "near"])

    return run


def _texts(src: DataFrame, keys: DataFrame) -> DataFrame:
    """h, t: the normal forms of the lines with the given keys; keys: h and the rid of a row that has it."""
    wanted = cut(keys.groupBy(F.col("rid").alias("_r")).agg(F.collect_set("h").alias("_h")))
    # repeated rows share a rid: any of them gives the line
    return cut(src.select("rid", "text").join(small(wanted, 80, "shuffle_hash"), F.col("rid") == F.col("_r")).select("text", "_h").mapInArrow(K.released(_wanted_lines), "h long, t string").dropDuplicates(["h"]))


def _verify(texts: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """a, b, near: whether the normal forms of two keys are similar enough."""
    both = pairs.join(texts.select(F.col("h").alias("a"), F.col("t").alias("ta")), "a").join(texts.select(F.col("h").alias("b"), F.col("t").alias("tb")), "b")
    return cut(both.select("a", "b", "ta", "tb").mapInArrow(K.released(_check(similarity)), "a long, b long, near boolean"))


def _simhash_links(src: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Verified pairs a, b of those whose SimHashes are near."""
    spark = ship(src.sparkSession)
    steps = S.length_steps(similarity)
    hashed = nodes.where("s IS NOT NULL")
    parts = partitions(spark, -(-hashed.count() * len(S.ROUTES) // VALUES_PER_PART))
    met = cut(hashed.select("s", "x").mapInArrow(K.released(S.scatter(parts)), P.SCHEMA).repartitionById(parts, F.col("part")).mapInArrow(K.released(S.meet(steps)), S.PAIRS))
    free_shuffles(spark)
    forest = cut(met.repartition(max(1, -(-met.count() // EDGES_PER_TASK)), "sa").mapInArrow(K.released(S.spanning), S.PAIRS))
    ends = F.explode(F.array(*[F.struct(F.col(f"s{c}").alias("s"), F.col(f"x{c}").alias("x")) for c in "ab"])).alias("e")
    ids = cut(forest.select(ends).select("e.*").distinct())
    members = cut(hashed.join(small(ids), ["s", "x"]).select("h", "s", "x", "rid"))
    reps = cut(members.groupBy("s", "x").agg(F.min("h").alias("rep"), F.count("*").alias("n")))
    left, right = (reps.select(F.col("s").alias(f"s{c}"), F.col("x").alias(f"x{c}"), F.col("rep").alias(c), F.col("n").alias(f"n{c}")) for c in "ab")
    several = members.join(reps, ["s", "x"]).where("h != rep").select(F.col("rep").alias("a"), F.col("h").alias("b"))
    edges = cut(forest.where("sa != sb OR xa != xb").join(left, ["sa", "xa"]).join(right, ["sb", "xb"]))
    tried = cut(_ordered(edges.select("a", "b").unionByName(several)))
    texts = _texts(src, members)
    free_shuffles(spark)
    checked, group = _verify(texts, tried, similarity), None
    ends_ab = ["sa", "xa", "sb", "xb"]
    seen = edges.where("na = 1 AND nb = 1").select(*ends_ab)  # of lines with equal SimHashes only one has been tried
    for closest in CLOSEST:
        # only where a pair of the forest failed can another pair be needed: there, across different components, each
        # line's closest others, then all
        links = checked.where("near").select("a", "b")
        failed = checked.where("NOT near").select(F.col("a").alias("h")).distinct()
        if failed.isEmpty():
            break
        group, label = group or cut(components(tried)), cut(components(links))
        touched = group.join(failed, F.col("node") == F.col("h")).select(F.col("label").alias("_g")).distinct()
        of_label = F.coalesce(F.col("l"), F.col("node"))
        apart = (
            group.join(label.select(F.col("node").alias("_n"), F.col("label").alias("l")), F.col("node") == F.col("_n"), "left")
            .groupBy(F.col("label").alias("g")).agg(F.min(of_label).alias("_a"), F.max(of_label).alias("_b"), F.count("*").alias("c"))
            .where("_a != _b AND c > 2").join(touched, F.col("g") == F.col("_g")).select("g", "c")  # in two there was but one pair
        )
        inside = cut(
            join_few(group, cut(apart), "label", "g", group.count).select(F.col("node").alias("h")).join(members.select("h", "s", "x"), "h")
            .join(label.select(F.col("node").alias("_n"), "label"), F.col("h") == F.col("_n"), "left").select("h", "s", "x", F.coalesce("label", "h").alias("label"))
        )
        if closest is None:  # all that is left: most of it fails, and is tried where it meets
            some = max(1, -(-inside.count() * len(S.ROUTES) // TEXTS_A_ROUND))
            failed = checked.where("NOT near").groupBy(F.col("a").alias("_a")).agg(F.collect_set("b").alias("failed"))
            known = inside.join(texts, "h").join(failed, F.col("h") == F.col("_a"), "left")
            met = known.select("s", "x", "label", "h", "t", "failed").mapInArrow(K.released(S.scatter_texts(some)), "part int, m binary").repartitionById(some, F.col("part"))
            last = cut(met.mapInArrow(K.released(S.verify_across(steps, lambda t, u: E.distances(t, u, similarity) >= 0)), "a long, b long"))
            free_shuffles(spark)
            return links.unionByName(last)
        by_sim = inside.groupBy("s", "x").agg(F.when(F.min("label") == F.max("label"), F.min("label")).otherwise(F.lit(S.MANY_LABELS)).alias("label"))
        some = max(1, -(-inside.count() * len(S.ROUTES) // VALUES_A_ROUND))
        near_pairs = by_sim.select("s", "x", "label").mapInArrow(K.released(S.scatter(some)), P.SCHEMA).repartitionById(some, F.col("part")).mapInArrow(K.released(S.meet_across(steps, closest)), f"{S.PAIRS}, whole boolean")
        near_pairs = cut(near_pairs.groupBy(*ends_ab).agg(F.bool_and("whole").alias("whole")))
        same = by_sim.where(F.col("label") == S.MANY_LABELS).select(F.col("s").alias("sa"), F.col("x").alias("xa"), F.col("s").alias("sb"), F.col("x").alias("xb"))
        a, b = (inside.select(F.col("s").alias(f"s{c}"), F.col("x").alias(f"x{c}"), F.col("h").alias(c), F.col("label").alias(f"l{c}")) for c in "ab")
        new = cut(near_pairs.select(*ends_ab).join(seen, ends_ab, "left_anti"))
        more = new.unionByName(same).join(a, ["sa", "xa"]).join(b, ["sb", "xb"]).where("la != lb").select("a", "b")
        more = cut(_ordered(more).join(checked, ["a", "b"], "left_anti"))
        checked = cut(checked.unionByName(_verify(texts, more, similarity)))
        seen = seen.unionByName(new)
        free_shuffles(spark)
        if near_pairs.where("NOT whole").isEmpty():  # those were all
            break
    return checked.where("near").select("a", "b")


def _gram_links(src: DataFrame, nodes: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """Verified pairs a, b of those that meet by their grams."""
    parts = partitions(spark := src.sparkSession)
    ship(spark)
    runs = cut(
        src.select("id", "rid", "text").mapInArrow(G.scatter(parts, min_words), G.SCATTERED).repartitionById(parts, F.col("part"))
        .mapInArrow(G.meet, G.RUNS).dropDuplicates(["run"])
    )
    free_shuffles(spark)
    tried = cut(runs.mapInArrow(G.stars(similarity), "a long, b long").distinct())
    keys = nodes.select("h", "rid")
    texts = _texts(src, tried.select(F.explode(F.array("a", "b")).alias("h")).distinct().join(keys, "h"))
    links = _verify(texts, tried, similarity).where("near").select("a", "b")
    free_shuffles(spark)
    members = runs.where(F.size("h") > 2).select("run", F.explode(F.arrays_zip("size", "h")).alias("m")).select("run", "m.size", "m.h")
    members = cut(members.join(components(links), F.col("h") == F.col("node"), "left").select("run", "size", "h", F.coalesce("label", "h").alias("label")))
    apart = members.groupBy("run").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a != _b").select("run")
    more = (
        members.join(apart, "run").groupBy("run").agg(F.collect_list(F.struct("size", "h", "label")).alias("m")).select("m")
        .mapInArrow(G.across(similarity), "a long, b long").distinct().join(tried, ["a", "b"], "left_anti")
    )
    more = cut(more)
    texts = _texts(src, more.select(F.explode(F.array("a", "b")).alias("h")).distinct().join(keys, "h"))
    links = cut(links.unionByName(_verify(texts, more, similarity).where("near").select("a", "b")))
    free_shuffles(spark)
    return links


def find_repeats(src: DataFrame, min_words: int, similarity: float, grams: bool = False) -> DataFrame:
    """src: id, rid, text. rid and line of the lines that go: all of their group but the first."""
    ship(src.sparkSession)
    id_type = src.schema["id"].dataType.simpleString()
    lines = cut(src.select("id", "rid", "text").mapInArrow(K.released(_lines(min_words, not grams)), f"id {id_type}, rid long, line int, h long, s long, x int"))
    nodes = cut(lines.groupBy("h", "s", "x").agg(F.min("rid").alias("rid"), F.count("*").alias("c")))  # fixed widths: aggregated by hash
    links = _gram_links(src, nodes, min_words, similarity) if grams else _simhash_links(src, nodes, similarity)
    labels = cut(components(links)).select(F.col("node").alias("_n"), "label")
    of_label = small(labels)
    groups = cut(
        nodes.join(of_label, F.col("h") == F.col("_n")).select(F.col("h").alias("_h"), F.col("label").alias("g"), "c")
        .unionByName(nodes.where("c > 1").join(of_label, F.col("h") == F.col("_n"), "left_anti").select(F.col("h").alias("_h"), F.col("h").alias("g"), "c"))
    )
    repeats = cut(join_few(lines.select("id", "rid", "line", "h"), groups, "h", "_h", lines.count).select("id", "rid", "line", "g"))
    first = cut(repeats.groupBy(F.col("g").alias("_g")).agg(F.min(F.struct("id", "rid", "line")).alias("keep"), F.count("*").alias("c")))
    return join_few(repeats, first, "g", "_g", repeats.count, row_bytes=64).where(F.struct("id", "rid", "line") != F.col("keep")).select("rid", "line")


MANY_GONE = 64


def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """The texts without the lines of those numbers; null where there are none."""
    out = []
    for t, g in zip(texts, gone):
        if t.is_valid and g.is_valid:
            off = set(g.as_py())
            out.append("\n".join([x for i, x in enumerate(t.as_py().split("\n")) if i not in off]))
        else:
            out.append(None)
    return pa.array(out, pa.string())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5, similarity: float = 0.9, grams: bool = False) -> DataFrame:
    """The rows of docs with the texts that remain, and _lines and _removed: how many lines a text had and lost.

    The appended columns have more underscores in front where docs has columns of their names.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at_id, at_text = docs.columns.index(id_col), docs.columns.index(text_col)
    text = F.col(f"c{at_text}")
    plain = plain.withColumn("rid", F.xxhash64(F.col(f"c{at_id}"), text))
    src = plain.select(F.col(f"c{at_id}").alias("id"), "rid", text.alias("text"))
    gone = cut(find_repeats(src, min_words, similarity, grams).groupBy(F.col("rid").alias("_g")).agg(F.collect_set("line").alias("gone")))
    free_shuffles(docs.sparkSession)
    joined = plain.join(small(gone, 80, "shuffle_hash"), F.col("rid") == F.col("_g"), "left")
    # the search in a list of numbers is for short lists; long ones go through a set
    many = F.size("gone") > MANY_GONE
    some = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n")
    left = F.when(many, F.arrow_udf(_without, "string")(F.when(many, text), F.when(many, F.col("gone")))).otherwise(some)
    count = F.when(text.isNull() | (text == ""), 0).otherwise(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    done = joined.select(*[F.when(F.col("gone").isNull(), text).otherwise(left) if i == at_text else F.col(f"c{i}") for i in range(len(docs.columns))],
                         count.alias("_lines"), F.coalesce(F.size("gone"), F.lit(0)).alias("_removed"))
    return done.toDF(*docs.columns, fresh(docs.columns, "_lines"), fresh(docs.columns, "_removed"))

"""Mix sources to target weights with DataFrame operations only.

Sources, in order of their names (code points, null last), get the weights `weights`, repeating, and share
`share` times all words. A source can give at most `epochs` times its own words: targets stop there and the excess is
shared out again by weight until no target is above its limit. That is water-filling, so it has a closed form: in
order of limit/weight, sources are full until the level of the rest falls below their limit.

Within a source, documents are sorted by a hash-random key. Whole epochs are taken first; of the rest, documents are
taken in key order up to the exact budget, floor(target), so the last document may count in part.

The sort is never done by one task for a whole source. Keys are cut in equal ranges (`rows_per_range` rows on
average); a prefix sum over the ranges' totals finds the one range that holds a source's cut; only its rows are
sorted. Ranges before it are taken whole, ranges after it not at all.

Null text: size 0, taken 0. Null source: a source of its own, the last. Null doc_id: a key like any other. Repeated
rows count each; equal keys are ordered by doc_id, then size. An empty table gives an empty result. Extra columns
pass through unless `keep` names the ones to return.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, words_of

KEY_HEX = 15
SALTS = 64


def random_key(doc_id: Column, seed: str = "") -> Column:
    """60 bits of the MD5 of the id as text (and the seed); null ids count as the empty text."""
    text = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, KEY_HEX), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: tuple[int, int] = (3, 2), epochs: int = 2) -> DataFrame:
    """source, source_size (one row per source) -> with weight and target; exact integers up to the last division."""
    num, den = share
    whole = "decimal(38,0)"
    w = reduce(lambda c, x: c.when(F.col("_i") % len(weights) == x[0], x[1]), list(enumerate(weights))[1:], F.when(F.col("_i") % len(weights) == 0, weights[0]))
    # the frames below hold one row per source
    ranked = sizes.withColumn("_i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("weight", w.cast("long"))
    level = Window.orderBy((F.col("_limit").cast("double") / F.col("weight")).asc(), F.col("_i").asc())
    before, on = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    x = (
        ranked.withColumn("_limit", (F.col("source_size") * epochs).cast(whole))
        .withColumn("_full", F.coalesce(F.sum("_limit").over(before), F.lit(0)).cast(whole))
        .withColumn("_w", F.sum("weight").over(on).cast(whole))
        .withColumn("_all", (F.sum("source_size").over(everything) * num).cast(whole))
        .withColumn("_left", (F.col("_all") - den * F.col("_full")).cast(whole))  # den * what the rest shares
    )
    # a source is full if its limit is within its part of what the fuller ones leave
    x = x.withColumn("_is_full", F.col("_limit") * den * F.col("_w") <= F.col("_left") * F.col("weight"))
    first = Window.partitionBy().orderBy(F.col("_is_full").asc(), F.col("_pos").asc())
    x = x.withColumn("_pos", F.row_number().over(level))
    x = x.withColumn("_l", F.first(F.when(~F.col("_is_full"), F.col("_left")), True).over(first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    x = x.withColumn("_lw", F.first(F.when(~F.col("_is_full"), F.col("_w")), True).over(first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("_is_full"), F.col("_limit").cast("double")).otherwise(
        (F.col("weight") * F.col("_l")).cast("double") / (den * F.col("_lw")).cast("double"))
    return x.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: tuple[int, int] = (3, 2), epochs: int = 2,
        rows_per_range: int = 2000, seed: str = "", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep` columns with size, source_size, target and taken; one row per input row."""
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    sized = cut(docs.select(*kept, F.col("doc_id").alias("_id"), F.col("source").alias("_src"), words_of(F.col("text")).alias("size"),
                            random_key(F.col("doc_id"), seed).alias("_key")))
    ranges = F.greatest(F.lit(1), F.ceil(F.lit(sized.count() / rows_per_range))).cast("long")
    width = F.ceil(F.lit(16**KEY_HEX).cast("double") / ranges).cast("long")
    sized = sized.withColumn("_range", F.floor(F.col("_key") / width).cast("long"))

    per_range = cut(sized.groupBy("_src", "_range").agg(F.sum("size").alias("_words")))
    goal = targets(per_range.groupBy(F.col("_src").alias("source")).agg(F.sum("_words").alias("source_size")), weights, share, epochs)
    goal = cut(
        goal.withColumn("_budget", F.floor("target").cast("long"))
        .withColumn("_rounds", F.when(F.col("source_size") > 0, F.floor(F.col("_budget") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("_rest", F.col("_budget") - F.col("_rounds") * F.col("source_size"))
    )
    g = goal.withColumnRenamed("source", "_s")
    sums = Window.partitionBy("_src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        per_range.withColumn("_before", F.coalesce(F.sum("_words").over(sums), F.lit(0)))
        .join(g, F.col("_src").eqNullSafe(F.col("_s")))
        .where((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_words")))
        .select("_s", F.col("_range").alias("_cut"), F.col("_before"))
    )
    plan = cut(goal.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_s"), "source_size", "target", "_rounds", "_rest", "_cut", "_before"))
    # a hot source's rows meet their plan in SALTS tasks; those of the cut ranges by source and range
    salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = sized.withColumn("_salt", F.pmod("_range", F.lit(SALTS))).join(
        salted.withColumnRenamed("_salt", "_s2"), F.col("_src").eqNullSafe(F.col("_s")) & (F.col("_salt") == F.col("_s2")))
    at_cut = sized.join(plan.where(F.col("_cut").isNotNull()), F.col("_src").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_cut")))
    out = [F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)]
    # no cut range: the rest is 0 or, by rounding, the whole source
    outside = rows.where(F.col("_cut").isNull() | (F.col("_range") != F.col("_cut"))).select(
        *out, "size", "source_size", "target",
        (F.col("_rounds") * F.col("size") + F.when(F.col("_range") < F.col("_cut"), F.col("size")).otherwise(0)).alias("taken"))
    order = Window.partitionBy("_src").orderBy("_key", "_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        at_cut
        .withColumn("_at", F.col("_before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
        .select(*out, "size", "source_size", "target",
                (F.col("_rounds") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_at")))).alias("taken"))
    )
    return outside.unionByName(inside)

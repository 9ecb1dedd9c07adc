"""Checks against the source: table options, and what its version can do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import CaptureOptions

PARTITION_DELETE_PREIMAGES = (2026, 1, 0)


def version(text: Column) -> Column:
    """The first d.d.d in a text as a comparable struct, or null."""
    found = F.regexp_extract(text, r"(\d+\.\d+\.\d+)", 1)
    part = F.split(found, r"\.")
    return F.when(found != "", F.struct(*[F.get(part, F.lit(i)).cast("int").alias(n) for i, n in enumerate(("major", "minor", "patch"))]))


def at_least(text: Column, least: tuple[int, int, int]) -> Column:
    """False where there is no version to be read."""
    return F.coalesce(version(text) >= F.struct(*[F.lit(x).alias(n) for x, n in zip(least, ("major", "minor", "patch"))]), F.lit(False))


def table_errors(found: DataFrame, wanted: DataFrame, o: CaptureOptions) -> DataFrame:
    """(tbl, level, problem): found has tbl and options (map); wanted has tbl. A missing table is a warning.

    Where no image is asked for nothing is checked. Only the text `true`, in any case, counts as on.
    """
    opt = F.col("options")

    def on(name: str) -> Column:
        return F.lower(F.coalesce(opt[name], F.lit(""))) == "true"

    problems = [F.when(~on("enabled"), F.lit("cdc is not enabled"))]
    for needed, name in ((o.needs_pre, "preimage"), (o.needs_post, "postimage")):
        if needed:
            problems.append(F.when(on("enabled") & ~on(name), F.lit(f"{name} is not enabled")))
    asked = wanted.select("tbl").distinct()
    joined = (asked if o.needs_pre or o.needs_post else asked.where(F.lit(False))).join(found.select("tbl", "options"), "tbl", "left")
    missing = F.when(opt.isNull(), F.array(F.struct(F.lit("warning").alias("level"), F.lit("the table was not found").alias("problem"))))
    errors = F.transform(F.filter(F.array(*problems), lambda x: x.isNotNull()), lambda x: F.struct(F.lit("error").alias("level"), x.alias("problem")))
    return joined.select("tbl", F.explode(F.coalesce(missing, errors)).alias("e")).select("tbl", "e.level", "e.problem")

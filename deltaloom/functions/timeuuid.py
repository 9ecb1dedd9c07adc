"""Time UUIDs as text: their time, their bytes, and the two orders they are compared by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: 100 ns steps between 1582-10-15 and 1970-01-01 (a fixed value).
EPOCH_STEPS = 122192928000000000


def _c(u: Column | str) -> Column:
    return F.col(u) if isinstance(u, str) else u


def steps(u: Column | str) -> Column:
    """The 60-bit timestamp in 100 ns steps since 1582."""
    u = _c(u)
    return F.conv(F.concat(F.substring(u, 16, 3), F.substring(u, 10, 4), F.substring(u, 1, 8)), 16, 10).cast("long")


def micros(u: Column | str) -> Column:
    """Microseconds since 1970, rounded down (integer arithmetic throughout)."""
    since = steps(u) - F.lit(EPOCH_STEPS)
    return F.call_function("div", since - F.pmod(since, F.lit(10)), F.lit(10))


def from_micros(us: Column | str, node: Column | str) -> Column:
    """A time UUID of a moment; node: a number that tells UUIDs of one moment apart."""
    t = F.lpad(F.lower(F.hex(_c(us).cast("long") * 10 + EPOCH_STEPS)), 15, "0")
    tail = F.lpad(F.lower(F.hex(_c(node).cast("long"))), 12, "0")
    return F.concat_ws("-", F.substring(t, 8, 8), F.substring(t, 4, 4), F.concat(F.lit("1"), F.substring(t, 1, 3)), F.lit("8000"), tail)


def signed_order(u: Column | str) -> Column:
    """Sort key: both 64-bit halves compared as signed numbers. The low time bits lead, so it isn't chronological."""
    plain = F.replace(_c(u), F.lit("-"), F.lit(""))
    return F.struct(F.conv(F.substring(plain, 1, 16), 16, -10).cast("long").alias("high"), F.conv(F.substring(plain, 17, 16), 16, -10).cast("long").alias("low"))


def chronological_order(u: Column | str) -> Column:
    return F.struct(steps(u).alias("t"), _c(u).alias("u"))

"""Allow and block lists of URLs: a trie over reversed host labels and path segments, longest match first.

A rule is (host, path, verdict). It fits a URL whose host is the rule's host or a subdomain of it and whose path
starts with the rule's path. Of all rules that fit, the one with the most host labels wins, then the one with the
longest path; an allow entry wins over a block entry for the same host and path.

The trie is broadcast, so its size is checked: lists of more than `broadcast_limit` rules are joined instead, each
URL's host suffixes against the rules' hosts, with the same precedence.

Nulls, URLs without `://`, empty texts: host and path are empty; only a rule with an empty host fits them. Ties and
repeated rows are judged alike, one result per input row. An empty table or an empty list gives the default verdict.
Columns of the input other than the URL pass through; result columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import fresh, ship

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("host", "path", "rule", "verdict")


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def labels(host: str) -> list[str]:
    return host.split(".")[::-1] if host else []


class Trie:
    """Host labels from the right lead to a node; a node's paths are a second trie over `/` segments.

    A path's last segment may match only the beginning of the URL's segment, so each path node keeps, beside its
    whole segments, the open endings that are compared by prefix.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for r in rules:
            node = self.root
            for x in labels(r.host):
                node = node.setdefault("labels", {}).setdefault(x, {})
            *whole, last = r.path.split("/")
            at = node.setdefault("paths", {})
            for x in whole:
                at = at.setdefault("next", {}).setdefault(x, {})
            at = at.setdefault("open", {})
            if at.get(last, ("", "block"))[1] != "allow":
                at[last] = (r.host + r.path, r.verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        node, passed = self.root, [self.root]
        for x in labels(host):
            node = node.get("labels", {}).get(x)
            if node is None:
                break
            passed.append(node)
        segments = path.split("/")
        for node in reversed(passed):
            if "paths" in node and (hit := self._path(node["paths"], segments)):
                return hit
        return None

    @staticmethod
    def _path(at: dict, segments: list[str]) -> tuple[str, str] | None:
        hit = None
        for i, x in enumerate(segments):
            if found := [(len(k), v) for k, v in at.get("open", {}).items() if x.startswith(k)]:
                hit = max(found)[1]
            at = at.get("next", {}).get(x)
            if at is None:
                break
        return hit


def with_trie(df: DataFrame, url: str, rules: list[Rule], default: str) -> DataFrame:
    """One Arrow pass; the trie travels as a broadcast variable."""
    held = ship(df.sparkSession).sparkContext.broadcast(Trie(rules))

    @F.udf(T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]), useArrow=True)
    def judge(host, path):
        hit = held.value.find(host, path)
        return hit if hit else (None, default)

    kept = [F.col(c) for c in df.columns if c not in RESULT]
    hp = df.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    hit = fresh(hp.columns, "_judged")
    return hp.withColumn(hit, judge("host", "path")).select(*hp.columns, f"{hit}.rule", f"{hit}.verdict")


def with_join(df: DataFrame, url: str, rules: DataFrame, default: str) -> DataFrame:
    """For lists too long to broadcast: distinct (host, path) pairs against the rules by host suffix."""
    best = (
        rules.select(F.col("host").alias("_rh"), F.col("path").alias("_rp"), F.col("verdict").alias("_rv"))
        .groupBy("_rh", "_rp").agg(F.min("_rv").alias("_rv"))  # 'allow' sorts before 'block'
    )
    kept = [F.col(c) for c in df.columns if c not in RESULT]
    hp = df.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    parts = F.split("host", r"\.")
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_join(F.slice(parts, i + 1, n - i), "."))
    asked = hp.select("host", "path").distinct()
    hits = (
        asked.withColumn("_rh", F.explode(F.array_distinct(F.concat(suffixes, F.array(F.lit(""))))))
        .join(best, "_rh").where(F.col("path").startswith(F.col("_rp")))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.when(F.col("_rh") == "", 0).otherwise(F.size(F.split("_rh", r"\."))).alias("a"),
                            F.length("_rp").alias("b"), F.concat("_rh", "_rp").alias("rule"), F.col("_rv").alias("verdict"))).alias("_hit"))
    )
    return hp.join(hits, ["host", "path"], "left").select(
        *[c for c in df.columns if c not in RESULT], "host", "path", F.col("_hit.rule").alias("rule"),
        F.coalesce("_hit.verdict", F.lit(default)).alias("verdict"))


def filter_urls(df: DataFrame, url: str, rules: DataFrame | Iterable[Rule], default: str = "allow", broadcast_limit: int = 100_000) -> DataFrame:
    """Add host, path, rule and verdict to each row; see the module's text for the rules and odd inputs."""
    if isinstance(rules, DataFrame):
        few = [Rule(r.host or "", r.path or "", r.verdict) for r in rules.select("host", "path", "verdict").limit(broadcast_limit + 1).collect()]
        if len(few) > broadcast_limit:
            return with_join(df, url, rules, default)
    else:
        few = list(rules)
        if len(few) > broadcast_limit:
            made = df.sparkSession.createDataFrame(few, "host string, path string, verdict string")
            return with_join(df, url, made, default)
    return with_trie(df, url, few, default)

"""URL filters: allow and block rules in a trie over reversed host labels, then over path segments.

A rule is a host and the start of a path. It fits that host and its subdomains, for paths that start with the rule's;
of the rules that fit, the longest wins. A node of the trie stands for a host; below it hang the whole segments of paths,
and at each of those the rest of a rule's path that ends inside a segment. A URL walks down its labels from the last one,
and at each host with rules down its segments: its cost follows its own length, not the number of rules.

The trie is sent to all tasks if the rules' size, which is counted, is within a bound. Beyond it, URLs look up
the rules of each of their hosts and path starts by a join.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.vocab import lookup
from wordloom.sources.session import saved

VERDICTS = ("allow", "block")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    def __post_init__(self):
        if self.verdict not in VERDICTS or not self.host:
            raise ValueError(f"no rule: {self}")

    @property
    def written(self) -> str:
        return self.host + self.path

    @property
    def weight(self) -> tuple[int, int, bool]:
        """Which of the rules that fit wins: the longest; of equal ones that of the longer host, then the blocking one."""
        return len(self.written), len(self.host), self.verdict == "block"


@dataclass
class Segments:
    """rules: by what is left of their path behind the last whole segment; sizes: the lengths of those, longest first."""

    below: dict[str, Segments] = field(default_factory=dict)
    rules: dict[str, Rule] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)


@dataclass
class Labels:
    below: dict[str, Labels] = field(default_factory=dict)
    paths: Segments | None = None


def trie(rules: Iterable[Rule]) -> Labels:
    """Rules that repeat each other count once; of a rule that both allows and blocks, the block stays."""
    root = Labels()
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.below.setdefault(label, Labels())
        node.paths = at = node.paths or Segments()
        *whole, rest = rule.path.split("/")
        for segment in whole:
            at = at.below.setdefault(segment, Segments())
        if rest not in at.rules or rule.weight > at.rules[rest].weight:
            at.rules[rest] = rule
        at.sizes = sorted({len(r) for r in at.rules}, reverse=True)
    return root


def longest(root: Labels, host: str, path: str) -> Rule | None:
    """The rule that wins for a host and path."""
    best, node = None, root
    for label in reversed(host.split(".")):
        node = node.below.get(label)
        if node is None:
            break
        at, start = node.paths, 0
        while at is not None:
            for size in at.sizes:
                rule = at.rules.get(path[start : start + size])
                if rule is not None and (best is None or rule.weight > best.weight):
                    best = rule
            end = path.find("/", start)
            if end < 0:
                break
            at, start = at.below.get(path[start:end]), end + 1
    return best


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to / ? # or the end, A-Z lower-cased; path: then up to ? # or the end.

    Both are empty for a null URL and one without `://`.
    """
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def by_trie(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """urls (with host and path) and _won, the winning rule as verdict and text, by a trie that every task gets."""
    shared = urls.sparkSession.sparkContext.broadcast(sorted({(r.verdict, r.host, r.path) for r in rules}))
    kinds = [(f.name, f.dataType.simpleString()) for f in urls.schema]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = trie(Rule(*r) for r in shared.value)
        for batch in batches:
            found = [longest(root, h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            won = pa.array([None if r is None else f"{r.verdict} {r.written}" for r in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, won], [*batch.schema.names, "_won"])

    return urls.mapInArrow(work, ", ".join(f"`{n}` {k}" for n, k in kinds) + ", _won string")


def by_join(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """The same by joins, for rules of any size: rows of urls are told apart by _row."""
    spark = urls.sparkSession
    table = spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string")
    # A key is a host and the whole segments of a path; what is left of the rule's path is compared behind it.
    whole = F.regexp_extract("path", r"(?s)^(.*/)?[^/]*$", 1)
    entry = F.struct("verdict", "path", F.length("host").alias("size"), F.concat("host", "path").alias("written"))
    keyed = table.groupBy(F.concat_ws("\n", "host", whole).alias("key")).agg(F.to_json(F.collect_list(entry)).alias("rules"))
    labels, parts = F.split("host", r"\."), F.split("path", "/")
    hosts = F.transform(F.sequence(F.lit(1), F.size("_l")), lambda i: F.array_join(F.slice("_l", i, F.size("_l")), "."))
    starts = F.transform(
        F.sequence(F.lit(0), F.size("_p") - 1), lambda i: F.when(i > 0, F.concat(F.array_join(F.slice("_p", 1, i), "/"), F.lit("/"))).otherwise(F.lit(""))
    )
    asked = urls.select("_row", "path", labels.alias("_l"), parts.alias("_p")).select("_row", "path", hosts.alias("_h"), starts.alias("_s"))
    asked = asked.select("_row", "path", F.explode("_h").alias("_h"), "_s").select("_row", "path", "_h", F.explode("_s").alias("_s"))
    found = lookup(asked.select("_row", "path", F.concat_ws("\n", "_h", "_s").alias("key")), keyed, "key", "rules").where("rules is not null")
    kind = "array<struct<verdict:string,path:string,size:int,written:string>>"
    each = found.select("_row", F.col("path").alias("_path"), F.inline(F.from_json("rules", kind))).where(F.startswith("_path", "path"))
    weight = F.struct(F.length("written"), "size", F.col("verdict") == "block", F.concat_ws(" ", "verdict", "written").alias("won"))
    best = each.groupBy("_row").agg(F.max(weight)["won"].alias("_won"))
    return urls.join(best, "_row", "left")


def judge(
    pages: DataFrame, rules: list[Rule], default: str = "allow", most_bytes: int = 32 << 20, id_column: str = "page_id"
) -> DataFrame:
    """id_column, host, path, rule and verdict of every row, in no shuffle while the rules fit most_bytes.

    rule is host and path of the winning one, null if none fits; then the verdict is `default`. A null URL and one without
    `://` have an empty host and path, which no rule fits. A path that is empty starts with no rule's path but an empty one.
    Rows that repeat are judged one by one, other columns are not read, and an empty table gives no rows.
    """
    if default not in VERDICTS:
        raise ValueError(f"no verdict: {default}")
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col(id_column).alias("_id"), host.alias("host"), path.alias("path"))
    if sum(len(r.written.encode()) + 64 for r in rules) <= most_bytes:
        found = by_trie(urls, rules)
    else:
        # Written once, as the numbers of rows are used twice.
        found = by_join(saved(urls.withColumn("_row", F.monotonically_increasing_id())), rules)
    cut = F.locate(" ", "_won")
    return found.select(
        F.col("_id").alias(id_column), "host", "path", F.substring(F.col("_won"), cut + 1, F.length("_won")).alias("rule"),
        F.coalesce(F.substring_index("_won", " ", 1), F.lit(default)).alias("verdict"),
    )

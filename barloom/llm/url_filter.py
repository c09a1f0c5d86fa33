"""Allow and block lists for urls: a trie over reversed host labels and path segments.

A rule names a host and the beginning of a path. It fits its host and every subdomain, and every path
that begins with the rule's (also in the middle of a segment). Of all rules that fit, the one with
the most host labels decides, among those the one with the longest path.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import written

#: Bytes of rules in one broadcast trie; longer lists are searched in blocks of this size.
BLOCK_BYTES = 8 << 20

ALLOW, BLOCK = "allow", "block"

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def rule(verdict: str, text: str) -> Rule:
    """A rule from ``host/path``; without a slash it fits every path, also none."""
    if verdict not in (ALLOW, BLOCK):
        raise ValueError(f"{verdict!r} is neither {ALLOW!r} nor {BLOCK!r}")
    host, slash, path = text.partition("/")
    return Rule(host.translate(str.maketrans(_UPPER, _LOWER)), slash + path, verdict)


def url_host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A to Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def _segments(path: str) -> list[str]:
    """``/a/b`` as ``/``, ``a/``, ``b``: whole segments end in a slash, only the last may be open."""
    parts = path.split("/")
    return [p + "/" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


class Trie:
    """Host labels from the last to the first, then path segments, then the open end of a path.

    Edges are one dictionary from (node, token) to a node; a host's node and the root of its paths are
    different nodes, so labels and segments never meet.
    """

    def __init__(self, rules: Iterable[tuple[int, str, str]]):
        self._edges: dict[tuple[int, str], int] = {}
        self._rule: dict[int, int] = {}
        self._paths: dict[int, int] = {}
        self._open: dict[int, dict[str, int]] = {}
        self._nodes = 1
        for number, host, path in rules:
            node = 0
            for label in reversed(host.split(".")):
                node = self._child(node, label)
            if node not in self._paths:
                self._paths[node] = self._nodes
                self._nodes += 1
            node = self._paths[node]
            segments = _segments(path)
            tail = segments.pop() if segments and not segments[-1].endswith("/") else ""
            for segment in segments:
                node = self._child(node, segment)
            if tail:
                self._open.setdefault(node, {})[tail] = number
            else:
                self._rule[node] = number
        self._sizes = {n: sorted({len(t) for t in tails}, reverse=True) for n, tails in self._open.items()}

    def _child(self, node: int, token: str) -> int:
        key = (node, token)
        if key not in self._edges:
            self._edges[key] = self._nodes
            self._nodes += 1
        return self._edges[key]

    def _path_rule(self, node: int, path: str) -> int | None:
        """The deepest rule below one host's path root."""
        best, at = self._rule.get(node), 0
        while True:
            for size in self._sizes.get(node, ()):
                found = self._open[node].get(path[at : at + size])
                if found is not None:
                    best = found
                    break
            end = path.find("/", at) + 1
            if not end:
                return best
            node = self._edges.get((node, path[at:end]))
            if node is None:
                return best
            best, at = self._rule.get(node, best), end

    def find(self, host: str, path: str) -> int | None:
        """Number of the longest rule that fits, None without one."""
        node, best, end = 0, None, len(host)
        while end >= 0:
            dot = host.rfind(".", 0, end)
            node = self._edges.get((node, host[dot + 1 : end]))
            if node is None:
                break
            root = self._paths.get(node)
            if root is not None:
                found = self._path_rule(root, path)
                best = best if found is None else found
            end = dot
        return best


def _blocks(rules: list[Rule]) -> Iterator[list[Rule]]:
    block, size = [], 0
    for r in rules:
        cost = len(r.host) + len(r.path) + 64
        if block and size + cost > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append(r)
        size += cost
    if block:
        yield block


def _search(spark: SparkSession, block: list[Rule]):
    """A user function (host, path) -> number in ``block`` of the longest rule that fits, else null."""
    shared = spark.sparkContext.broadcast([(n, r.host, r.path) for n, r in enumerate(block)])

    @F.pandas_udf("int")
    def search(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        trie = Trie(shared.value)
        for hosts, paths in batches:
            yield pd.Series([trie.find(h, p) for h, p in zip(hosts, paths)], dtype="Int32")

    return search


def filter_urls(df: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = ALLOW) -> DataFrame:
    """All rows and columns of ``df`` and ``host``, ``path``, ``rule``, ``verdict``.

    ``rule`` is the deciding rule as ``host/path``, null where none fits; ``verdict`` is then
    ``default``. A url that is null, empty or without ``://`` has an empty host and path, which no rule
    with a host fits. Rules given twice count once; if one is given for both verdicts, it blocks.
    Equal rows stay as they are, an empty table gives an empty one, no rules give ``default`` for
    all. A column of ``df`` that is named like one of the four (or begins
    with ``_rule_``) is refused.

    Rules are sorted and searched in blocks of ``BLOCK_BYTES``, one broadcast trie after the other, so a
    broadcast never grows with the list. Between blocks rows are written once; in no case are they
    shuffled or grouped, so no host can be a hot key.
    """
    reserved = {"host", "path", "rule", "verdict", "_rule_number", "_rule_found"}
    clash = reserved & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} would be overwritten")
    least: dict[tuple[str, str], str] = {}
    for host, path, verdict in rules:
        least[host, path] = BLOCK if BLOCK in (verdict, least.get((host, path))) else verdict
    ordered = [Rule(*key, least[key]) for key in sorted(least)]
    out = df.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    best = "struct<labels int, size int, rule string, verdict string>"
    out = out.withColumn("rule", F.lit(None).cast(best))
    for number, block in enumerate(_blocks(ordered)):
        if number:
            out = written(out, "urls")
        search = _search(df.sparkSession, block)
        named = df.sparkSession.createDataFrame(
            [(n, r.host.count(".") + 1, len(r.path), f"{r.host}{r.path}", r.verdict) for n, r in enumerate(block)],
            "_rule_number int, labels int, size int, rule string, verdict string",
        ).select("_rule_number", F.struct("labels", "size", "rule", "verdict").alias("_rule_found"))
        out = out.withColumn("_rule_number", search("host", "path")).join(F.broadcast(named), "_rule_number", "left")
        # Structs compare by labels, then by the length of the path.
        better = F.col("rule").isNull() | (F.col("_rule_found") > F.col("rule"))
        out = out.withColumn("rule", F.when(better, F.col("_rule_found")).otherwise(F.col("rule"))).drop("_rule_number", "_rule_found")
    return out.withColumn("verdict", F.coalesce("rule.verdict", F.lit(default))).withColumn("rule", F.col("rule.rule"))

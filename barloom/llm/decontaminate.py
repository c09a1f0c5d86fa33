"""Benchmark decontamination by pigeonhole edit matching (operator 4).

An item that occurs in a text with at most k edits, cut into k + 1 pieces, has one piece without
an edit. Exact piece hits are found with one automaton over all pieces of a block of items; each
hit's neighbourhood is then verified with the bit-parallel edit distance of Myers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WHITE = re.compile(r"\s+")
#: Share of an item's characters that may be edited.
ERROR_RATE = 0.05
#: Characters of items per block: bounds the automaton each task holds; more items, more blocks.
BLOCK_CHARS = 4_000_000
#: A shorter item counts only where it stands unedited between word borders, and is no reason to drop
#: a document.
MIN_CHARS = 20


class Match(NamedTuple):
    item: int
    begin: int
    end: int
    distance: int


def normalise(text: str | None) -> str:
    """Lower case, runs of white space as one blank."""
    return _WHITE.sub(" ", (text or "").lower()).strip()


def pieces(text: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of near equal length with their offsets."""
    n, k = len(text), errors + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_matches(pattern: str, text: str, errors: int) -> list[tuple[int, int]]:
    """(end, distance) of the occurrences of ``pattern`` in ``text`` within ``errors`` edits.

    Column by column, with the vertical differences of the edit matrix as bits of two integers. Ends
    next to each other are one occurrence as long as their distances fall and then rise; its best
    end counts, the first of equally good ones.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, distance = full, 0, m
    best = (0, m) if m <= errors else None
    out, before, rising = [], m, False
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        vertical = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (~(diagonal | plus) & full)
        down = plus & diagonal
        distance += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
        if distance > errors:
            if best:
                out.append(best)
            best, rising = None, False
        elif best is None:
            best, rising = (j + 1, distance), False
        elif distance < before and rising:
            out.append(best)
            best, rising = (j + 1, distance), False
        elif distance < best[1]:
            best = (j + 1, distance)
        rising = rising or (best is not None and distance > before)
        before = distance
    return out + [best] if best else out


def best_match(pattern: str, text: str, errors: int) -> tuple[int, int] | None:
    """(end, distance) of the best occurrence, the first of equally good ones; None beyond ``errors``."""
    return min(best_matches(pattern, text, errors), key=lambda m: (m[1], m[0]), default=None)


def _stands_alone(text: str, begin: int, end: int) -> bool:
    """Whether no word goes on beyond the borders of the part."""
    before, after = text[begin - 1 : begin], text[end : end + 1]
    return not (before.isalnum() and text[begin].isalnum()) and not (after.isalnum() and text[end - 1].isalnum())


class Matcher:
    """All items of one block; built once per task."""

    def __init__(self, items: Sequence[tuple[int, str]], error_rate: float):
        import ahocorasick

        self.items = [(i, t, int(len(t) * error_rate)) for i, t in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text, errors) in enumerate(self.items):
            for offset, piece in pieces(text, errors):
                places.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[Match]:
        """Matches in a normalised text, per item the separate places, by item and place."""
        if not text or not self.items:
            return []
        windows: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            begin = last + 1 - size
            for at, offset in where:
                _, item, errors = self.items[at]
                low = max(0, begin - offset - errors)
                high = min(len(text), begin - offset + len(item) + errors)
                known = windows.setdefault(at, [])
                # Hits of one occurrence, piece after piece, share their window.
                if known and low <= known[-1][0] + 2 * errors:
                    known[-1] = [min(low, known[-1][0]), max(high, known[-1][1])]
                else:
                    known.append([low, high])
        out = []
        for at, spans in windows.items():
            key, item, errors = self.items[at]
            for low, high in spans:
                for end, distance in best_matches(item, text[low:high], errors):
                    end += low
                    # Backwards from the end: the same distance, and so the begin.
                    back = best_match(item[::-1], text[max(0, end - len(item) - errors) : end][::-1], errors)
                    begin = end - back[0]
                    if len(item) >= MIN_CHARS or _stands_alone(text, begin, end):
                        out.append(Match(key, begin, end, distance))
        return sorted(set(out))


def blocks(items: Sequence[tuple[int, str]], chars: int) -> list[list[tuple[int, str]]]:
    out: list[list[tuple[int, str]]] = [[]]
    size = 0
    for item in items:
        if out[-1] and size + len(item[1]) > chars:
            out.append([])
            size = 0
        out[-1].append(item)
        size += len(item[1])
    return [b for b in out if b]


def benchmark_items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> list[tuple[int, str]]:
    """Items on the driver, normalised, by key; empty ones and null keys are left out.

    The benchmark is the stated query set; each of its texts is searched in all documents.
    """
    rows = benchmark.select(F.col(item).cast("bigint").alias("i"), F.col(text).alias("t")).where("i IS NOT NULL").collect()
    kept = {(r["i"], normalise(r["t"])) for r in rows}
    return sorted((i, t) for i, t in kept if t)


def find_leaks(
    documents: DataFrame,
    items: Sequence[tuple[int, str]],
    key: str = "doc_id",
    text: str = "text",
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per occurrence: ``key``, ``item_id``, ``begin``, ``end``, ``distance``.

    An item occurs where its normalised text lies within ``error_rate`` times its length edits of a
    part of the whole normalised document; begin and end are places in that normalised text. Items of
    under MIN_CHARS characters occur where they stand unedited between word borders. Occurrences may
    overlap; a begin is the one that makes the occurrence shortest.

    Nulls: null or empty texts and items have no match; null item keys are left out; a null
    document key stays null. Repeated documents each give their rows, repeated items one. Empty
    tables: no rows. Other columns are not read.

    Scale: no shuffle. Documents stream past the automaton of one block of items, whose size is
    bounded by ``block_chars``; a larger benchmark takes more passes, not more memory.
    """
    spark = documents.sparkSession
    schema = f"{key} bigint, item_id bigint, begin bigint, end bigint, distance int"
    rows = documents.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
    passes = [rows.mapInPandas(_finder(spark.sparkContext.broadcast(b), error_rate, key), schema) for b in blocks(items, block_chars)]
    if not passes:
        return spark.createDataFrame([], schema)
    found = passes[0]
    for more in passes[1:]:
        found = found.unionByName(more)
    return found


def _finder(sent, error_rate: float, key: str):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(sent.value, error_rate)
        for batch in batches:
            found = [(k, *m) for k, t in zip(batch["_key"], batch["_text"]) for m in matcher.find(normalise(t))]
            out = pd.DataFrame(found, columns=[key, "item_id", "begin", "end", "distance"])
            yield out.astype({key: "Int64"})

    return find


def without_leaks(documents: DataFrame, items: Sequence[tuple[int, str]], text: str = "text", error_rate: float = ERROR_RATE) -> DataFrame:
    """The documents in which no item occurs, with all their columns; a null text has none.

    Items of under MIN_CHARS characters are no reason to drop a document: a word or a name alone is
    no evidence that it holds the benchmark.
    """
    left = documents
    sc = documents.sparkSession.sparkContext
    items = [x for x in items if len(x[1]) >= MIN_CHARS]
    for block in blocks(items, BLOCK_CHARS):
        sent = sc.broadcast(block)
        left = left.where(~_tester(sent, error_rate)(F.col(text)))
    return left


def _tester(sent, error_rate: float):
    kept: list[Matcher] = []

    @F.pandas_udf("boolean")
    def leaked(texts: pd.Series) -> pd.Series:
        if not kept:
            kept.append(Matcher(sent.value, error_rate))
        return pd.Series([bool(kept[0].find(normalise(t))) for t in texts], dtype=bool)

    return leaked

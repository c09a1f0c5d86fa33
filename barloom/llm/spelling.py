"""Words within one inserted, deleted or replaced code point, found through a dictionary of trie nodes.

All prefixes of the vocabulary are nodes of a trie, all suffixes nodes of the trie of the reversed words.
A word that skips its position i stands in the dictionary under (node of what is before i, node of
what is after i), a word that skips nothing under (node before i, node from i) for every i. Nodes are
numbered, so a key is two integers, and equal keys mean equal strings:

- two words that skip a position under one key differ by the code point there;
- a word that skips a position and one that skips nothing differ by an inserted one.

Tries are numbered without being built: words are dealt by ranges of their order, and a word shares
the nodes of its common prefix with the word before it. No group depends on how frequent a word or
a beginning is; a key holds one word per code point that can stand at its gap, and one without.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import written

#: Code points of words in one range of a trie, about.
RANGE_CODE_POINTS = 4 << 20
#: Cells of the table of nodes (words by code points) that a task holds at a time.
CELLS = 1 << 20
#: Words sampled per range to find the ranges' limits, and code points of a limit. Both set only how
#: evenly ranges are cut.
SAMPLED, LIMIT_CODE_POINTS = 64, 32

#: Kinds of dictionary rows: nothing skipped; a position skipped; one skipped that equals the code
#: point before it. Skipping any of a run of equal code points gives one string, so only the first
#: of a run meets words that skip nothing.
WHOLE, GAP, REPEATED_GAP = 2, 1, 0


class _Range(NamedTuple):
    """What a task must know of one range of a sorted vocabulary."""

    first_node: int  # node of depth d of the range's word w: first_node + code points before w + d
    before: str | None  # last word of the range before
    after: str | None  # first word of the range behind
    last: str
    left: list[int]  # nodes of the prefixes that ``before`` shares with the range's first word
    right: list[int]  # nodes of the prefixes that ``last`` shares with ``after``


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    if a[: len(b)] == b:
        return len(b)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _limits(words: DataFrame, key: Column) -> list[str]:
    """Beginnings that cut the sorted keys into ranges of about RANGE_CODE_POINTS."""
    n, total = words.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("word")), F.lit(0))).first()
    ranges = -(-total // RANGE_CODE_POINTS)
    if ranges < 2:
        return []
    share = min(1.0, SAMPLED * ranges / n)
    drawn = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30)))
    starts = sorted(r[0] for r in drawn.select(F.left(key, F.lit(LIMIT_CODE_POINTS))).collect())
    return sorted({starts[len(starts) * k // ranges] for k in range(1, ranges)}) if starts else []


def _ranges(dealt: DataFrame) -> dict[int, _Range]:
    """The ranges of ``dealt`` (_range, _key); one row of each comes to the driver."""
    rows = sorted(dealt.groupBy("_range").agg(F.min("_key"), F.max("_key"), F.sum(F.length("_key") + 1)).collect())
    shared = [_common(a[2], b[1]) for a, b in zip(rows, rows[1:])]
    total = sum(r[3] for r in rows)
    # A prefix that crosses a limit between ranges has its node from the first limit it crosses.
    crossing: list[list[int]] = []
    for k, depth in enumerate(shared):
        known = crossing[-1][: min(depth, _common(rows[k][1], rows[k][2])) + 1] if k else []
        crossing.append(known + list(range(total, total + depth + 1 - len(known))))
        total += depth + 1 - len(known)
    out, node = {}, 0
    for k, (number, first, last, size) in enumerate(rows):
        out[number] = _Range(
            node, rows[k - 1][2] if k else None, rows[k + 1][1] if k + 1 < len(rows) else None, last,
            crossing[k - 1] if k else [], crossing[k] if k < len(crossing) else [],
        )
        node += size
    return out


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(words by longest word) code points padded with -1, and the lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    grid = np.full((len(words), int(sizes.max()) + 1), -1, np.int32)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
    grid[np.arange(grid.shape[1]) < sizes[:, None]] = flat
    return grid, sizes


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one range each, in order, at most about CELLS cells and one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(batch["_size"]) + 1
        ranges = np.asarray(batch["_range"])
        at = 0
        while at < len(sizes):
            widest = np.maximum.accumulate(sizes[at : at + CELLS // 8])
            fits = (widest * np.arange(1, len(widest) + 1) <= CELLS) & (ranges[at : at + len(widest)] == ranges[at])
            fits[0] = True
            step = int(np.argmin(fits)) if not fits.all() else len(fits)
            yield pa.Table.from_batches([batch.slice(at, step)])
            at += step


def _numbered(batches: Iterator[pa.RecordBatch], ranges: dict[int, _Range]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of sorted rows with their nodes (rows by depth), first nodes, and shared depths.

    A row's shared depth is that of its longest prefix that another word has, too.
    """
    chunks = _chunks(batches)
    chunk = next(chunks, None)
    of, before, row, node = None, None, None, 0
    while chunk is not None:
        following = next(chunks, None)
        number = chunk["_range"][0].as_py()
        if number != of:
            of, here = number, ranges[number]
            before, node, row = here.before, here.first_node, np.array(here.left, np.int64)
        words = chunk["_key"].to_pylist()
        same = following is not None and following["_range"][0].as_py() == of
        behind = following["_key"][0].as_py() if same else here.after
        grid, sizes = _code_points(words)
        width = grid.shape[1]
        joint = np.zeros(len(words) + 1, np.int64) - 1
        if len(words) > 1:
            differ = (grid[1:] != grid[:-1]) | (grid[1:] < 0)
            joint[1:-1] = differ.argmax(axis=1)
        joint[0] = -1 if before is None else _common(before, words[0])
        joint[-1] = -1 if behind is None else _common(words[-1], behind)
        begins = node + np.concatenate(([0], np.cumsum(sizes + 1)))
        depth = np.arange(width)
        owner = np.where(depth > joint[:-1, None], begins[:-1, None], np.int64(-1))
        np.maximum.accumulate(owner, axis=0, out=owner)
        nodes = np.where(owner < 0, 0, owner + depth)
        # Prefixes that the chunk's first word shares with the word before have that word's nodes.
        kept = int(joint[0]) + 1
        if kept:
            nodes[:, :kept] = np.where(owner[:, :kept] < 0, row[:kept], nodes[:, :kept])
        # Prefixes that cross the limit to the next range have the nodes agreed for it.
        crossing = np.array(here.right, np.int64)
        if len(crossing):
            upto = min(width, len(crossing))
            last = np.array([ord(c) for c in here.last[: upto - 1]], np.int32)
            equal = np.ones((len(words), upto), bool)
            equal[:, 1:] = np.logical_and.accumulate(grid[:, : upto - 1] == last, axis=1)
            nodes[:, :upto] = np.where(equal, crossing[:upto], nodes[:, :upto])
        yield chunk, nodes, begins[:-1], np.maximum(joint[:-1], joint[1:])
        before, node, row = words[-1], int(begins[-1]), nodes[-1]
        chunk = following


def _forward(ranges: dict[int, _Range]):
    """Rows get ``word_id`` (ascending with the word) and the nodes of their shared prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, nodes, begins, shared in _numbered(batches, ranges):
            n = shared + 1
            taken = nodes[np.arange(nodes.shape[1]) < n[:, None]]
            lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(n))).astype(np.int32), taken)
            yield pa.RecordBatch.from_arrays(
                [chunk["word"].combine_chunks(), chunk["n"].combine_chunks(), pa.array(begins), lists], ["word", "n", "word_id", "prefixes"]
            )

    return run


def _dictionary(ranges: dict[int, _Range]):
    """Rows (before, after, kind, word_id, n) of every word, positions with nodes of its own left out.

    A node that only one word has can be part of no key that another word has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, nodes, _, shared in _numbered(batches, ranges):
            grid, sizes = _code_points(chunk["word"].to_pylist())
            prefixes = chunk["prefixes"].combine_chunks()
            lengths = np.diff(np.asarray(prefixes.offsets))
            ahead = np.zeros(grid.shape, np.int64)
            ahead[np.arange(grid.shape[1]) < lengths[:, None]] = np.asarray(prefixes.flatten())
            place = np.arange(grid.shape[1])
            left = sizes[:, None] - place  # code points from a place on
            ids, counts = np.asarray(chunk["word_id"]), np.asarray(chunk["n"])
            repeated = np.zeros(grid.shape, bool)
            repeated[:, 1:] = grid[:, 1:] == grid[:, :-1]
            for skipped in (0, 1):
                rest = left - skipped
                row, at = np.nonzero((place < lengths[:, None]) & (rest >= 0) & (rest <= shared[:, None]))
                kind = np.where(repeated[row, at], REPEATED_GAP, GAP) if skipped else np.full(len(row), WHOLE)
                yield pa.RecordBatch.from_arrays(
                    [ahead[row, at], nodes[row, rest[row, at]], kind.astype(np.int8), ids[row], counts[row]],
                    ["before", "after", "kind", "word_id", "n"],
                )

    return run


def _in_ranges(words: DataFrame, key: Column) -> tuple[DataFrame, dict[int, _Range]]:
    """``words`` dealt and sorted by ranges of ``key``, and the ranges."""
    limits = _limits(words, key)

    @F.pandas_udf("int")
    def number(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: bisect_right(limits, k)).astype("int32")

    dealt = words.withColumn("_key", key).withColumn("_range", number("_key") if limits else F.lit(0))
    ranges = _ranges(dealt.select("_range", "_key"))
    columns = dealt.withColumn("_size", F.length("_key"))
    return columns.repartition(len(limits) + 1, "_range").sortWithinPartitions("_range", "_key"), ranges


def dictionary(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(words with ``word_id``, dictionary) of ``words`` (word, n), in which no word stands twice."""
    dealt, ranges = _in_ranges(words, F.col("word"))
    numbered = dealt.mapInArrow(_forward(ranges), "word string, n long, word_id long, prefixes array<long>")
    numbered = written(numbered, "spelling-words")
    dealt, ranges = _in_ranges(numbered, F.reverse("word"))
    rows = dealt.mapInArrow(_dictionary(ranges), "before long, after long, kind byte, word_id long, n long")
    return numbered.select("word", "n", "word_id"), rows


def near_words(rows: DataFrame) -> DataFrame:
    """From a dictionary: ``word_id``, ``n_near`` (number of near words), ``best_n`` and ``best_id``
    (the most frequent one, of equally frequent the least); words without near ones have no row.

    A key's words are compared where they are grouped: at most one per code point in use and one more.
    Each near pair has exactly one key, so counts are added up without a list of pairs.
    """
    members = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "word_id", "kind")))
    keys = rows.groupBy("before", "after").agg(members.alias("m")).where(F.size("m") > 1)

    def partners(x: Column, m: Column) -> Column:
        both_gaps = (x["kind"] != WHOLE) & (m["kind"] != WHOLE)
        inserted = (F.least(x["kind"], m["kind"]) == GAP) & (F.greatest(x["kind"], m["kind"]) == WHOLE)
        return (x["word_id"] != m["word_id"]) & (both_gaps | inserted)

    per_word = keys.select(F.explode(F.transform("m", lambda x: F.struct(x["word_id"].alias("word_id"), F.filter("m", lambda m: partners(x, m)).alias("near")))).alias("x"))
    per_word = per_word.select("x.word_id", F.size("x.near").alias("k"), F.get("x.near", F.lit(0)).alias("best")).where("k > 0")
    total = per_word.groupBy("word_id").agg(
        F.sum("k").cast("long").alias("n_near"), F.min(F.struct("best.less", "best.word_id")).alias("best")
    )
    return total.select("word_id", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.word_id").alias("best_id"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word_id``, ``root_id`` at the end of the chain of ``forms`` (word_id, form_id).

    A step goes to a word that is ten times as frequent, so chains are short; each round doubles the
    steps taken.
    """
    now = forms.select("word_id", F.col("form_id").alias("root_id"))
    while True:
        further = now.select(F.col("word_id").alias("root_id"), F.col("root_id").alias("_next"))
        now = written(
            now.join(further, "root_id", "left").select("word_id", F.coalesce("_next", "root_id").alias("root_id"), F.col("_next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        if not now.where("moved").limit(1).count():
            return now.select("word_id", "root_id")
        now = now.select("word_id", "root_id")


def group_spellings(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Per row of ``words`` (word, n): word, n, n_near, form, form_n, root.

    ``n_near`` counts the words that differ by exactly one inserted, deleted or replaced code point.
    ``form`` is the near word of largest n (ties: the smallest in code-point order) if that is at
    least ``ratio`` (over 1) times the word's n, else null; ``root`` is reached by following forms, the word
    itself without one.

    Rows of equal words are added up first; rows without a word or an n count nothing. The empty word
    is near all words of one code point. Further columns are left out. An empty table gives an
    empty one. Words may have any length; a task holds the nodes of about CELLS code points, or of one word.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    counted = words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    numbered, rows = dictionary(written(counted, "spelling-vocabulary"))
    near = near_words(rows)
    found = written(
        numbered.join(near, "word_id", "left").withColumn("is_form", F.col("best_n") >= ratio * F.col("n")),
        "spelling-near",
    )
    forms = found.where("is_form").select("word_id", F.col("best_id").alias("form_id"))
    named = found.select("word_id", "word")
    chains = forms.join(_roots(forms), "word_id")
    chains = chains.join(named.toDF("form_id", "form"), "form_id").join(named.toDF("root_id", "root"), "root_id")
    out = found.join(chains.select("word_id", "form", "root"), "word_id", "left")
    return out.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form",
        F.when(F.col("is_form"), F.col("best_n")).alias("form_n"), F.coalesce("root", "word").alias("root"),
    )


#: Runs of letters of at least seven code points; shorter ones can give no word of seven.
LEAST_CODE_POINTS = 7
_RUN = "[A-Za-zÀ-ÿ]{%d,}" % LEAST_CODE_POINTS
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(word: Column) -> Column:
    """A to Z lower-cased and nothing else; ``lower`` where no other letter has a case."""
    return F.when(word.rlike("[À-Þ]"), F.translate(word, _UPPER, _UPPER.lower())).otherwise(F.lower(word))


def vocabulary(df: DataFrame, key: str = "doc_id", text: str = "text", deleted_one_in: int = 31, least_count: int = 2) -> DataFrame:
    """``word``, ``n`` of all words of ``df`` with at least seven code points and ``least_count`` occurrences.

    Words are runs of letters, A to Z lower-cased. With h the crc32 of ``<key>:<word>``, a word whose h is
    divisible by ``deleted_one_in`` has lost its code point h % length (a null key stands as nothing).
    Null and empty texts have no words; repeated rows count each. Counts are combined before they are
    shuffled, so a frequent word is no hot key.
    """
    runs = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all(text, F.lit(_RUN), F.lit(0))).alias("_run"))
    word = runs.select("_id", lower_ascii(F.col("_run")).alias("word"))
    hashed = word.select("word", F.crc32(F.concat("_id", F.lit(":"), "word").cast("binary")).alias("_h"))
    at = (F.col("_h") % F.length("word")).cast("int")
    short = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    words = hashed.select(F.when(F.col("_h") % deleted_one_in == 0, short).otherwise(F.col("word")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_CODE_POINTS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)

"""Periodic runs of words: maximal stretches that repeat a period, at least four times.

Every maximal repetition has a Lyndon word as a root in one of two orders of the symbols, so the longest
Lyndon words that start at each place are all candidates. A candidate's period is extended to both
sides by longest common extensions, constant-time queries on the suffix trees of the words and of
their reversal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.storage import return_memory
from barloom.llm.suffix_tree import Extensions

#: A run has at least MIN_WORDS words and MIN_PERIODS periods.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Words compared to leave out places that can be in no run.
GRAM = 5
#: Words of texts that a task looks through at a time.
CHUNK_WORDS = 1 << 18

RUNS = "runs array<struct<start: long, length: long, period: long>>"


def _next_after(rank: list[int]) -> list[int]:
    """Per place the next one of smaller rank; the last place has the smallest."""
    out, stack = [0] * len(rank), []
    for place in range(len(rank) - 1, -1, -1):
        r = rank[place]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        out[place] = stack[-1] if stack else len(rank) - 1
        stack.append(place)
    return out


def all_runs(symbols: np.ndarray) -> np.ndarray:
    """All maximal repetitions of at least two periods: rows (start, length, period) by start, then period.

    ``symbols`` are integers from 0 to their number less one. The periods are the smallest ones.
    """
    size = len(symbols)
    if size < 2:
        return np.zeros((0, 3), np.int64)
    ahead, back = Extensions(symbols), Extensions(symbols[::-1])
    place = np.arange(size)
    found = []
    for rank in (ahead.rank, -ahead.rank):
        # The longest Lyndon word at a place ends before the next smaller suffix. The text's end is a
        # symbol below all others in one order and above them in the other.
        after = np.array(_next_after(rank.tolist()), np.int64)[:-1]
        period = after - place
        right = ahead(place, after)
        # The word before a place is at ``size - place`` of the reversal.
        left = back(size - place, size - after)
        whole = left + period + right >= 2 * period
        if rank is not ahead.rank:
            whole &= after < size  # else that word holds the end itself
        found.append(np.stack((place - left, period, left + period + right), 1)[whole])
    return np.unique(np.concatenate(found), axis=0)[:, [0, 2, 1]]


def _candidate_places(symbols: np.ndarray) -> np.ndarray:
    """Per place of the joined texts (each ended by a negative number), whether GRAM words begin there
    that may lie in a run.

    In a run of at least MIN_WORDS words and MIN_PERIODS periods the words at every place (but for the
    last GRAM - 1) stand again a period before or behind, and the period is at most a fourth of the stretch
    of such places. Places whose words don't stand again that near are left out, until no stretch
    gets shorter. Equal hashes of different words only keep places.
    """
    n = len(symbols) - GRAM + 1
    if n < 1:
        return np.zeros(0, bool)
    mixed = np.zeros(n, np.uint64)
    values = symbols.astype(np.uint64)
    for k in range(GRAM):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + values[k : k + n]
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    far = np.iinfo(np.int64).max // 8
    gap = np.where(mixed[order][1:] == mixed[order][:-1], np.diff(order), far)
    near = np.empty(n, np.int64)
    near[order] = np.minimum(np.concatenate(([far], gap)), np.concatenate((gap, [far])))
    alive = near < far
    for k in range(GRAM):  # never across the end of a text
        alive[np.clip(np.flatnonzero(symbols < 0) - k, 0, n - 1)] = False
    while alive.any():
        edges = np.flatnonzero(np.diff(np.concatenate(([0], alive.view(np.int8), [0]))))
        begin, end = edges[::2], edges[1::2]
        words = np.repeat(end - begin + GRAM - 1, end - begin)
        places = np.flatnonzero(alive)
        gone = places[(MIN_PERIODS * near[places] > words) | (words < MIN_WORDS)]
        if not len(gone):
            break
        alive[gone] = False
    return alive


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Per text (its words) the runs that are long enough: sorted rows (start, length, period)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    known: dict[bytes, int] = {}
    joined = np.empty(int(sizes.sum()) + len(texts), np.int64)
    at = 0
    for number, words in enumerate(texts):
        for word in dict.fromkeys(words):
            known.setdefault(word, len(known))
        joined[at : at + len(words)] = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        joined[at + len(words)] = -1 - number  # a word of its own ends every text
        at += len(words) + 1
    del known
    alive = _candidate_places(joined)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], alive.view(np.int8), [0]))))
    out: list[list[np.ndarray]] = [[] for _ in texts]
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        number = int(np.searchsorted(begins, begin, "right")) - 1
        symbols = np.unique(joined[begin : end + GRAM - 1], return_inverse=True)[1]
        runs = all_runs(symbols)
        runs = runs[(runs[:, 1] >= MIN_WORDS) & (runs[:, 1] >= MIN_PERIODS * runs[:, 2])]
        runs[:, 0] += begin - begins[number]
        out[number].append(runs)
    return [np.concatenate(found) if found else np.zeros((0, 3), np.int64) for found in out]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period, joined by a space."""
    if not len(runs):
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()])


def _run_column(runs: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
    flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
    fields = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    return pa.ListArray.from_arrays(offsets, fields)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return_memory()
    for batch in batches:
        column, keys = batch["_text"], batch["_key"]
        at = 0
        while at < batch.num_rows:
            texts, words, first = [], 0, at
            while at < batch.num_rows and (not texts or words < CHUNK_WORDS):
                # Blanks are those of ASCII: space, and tab to carriage return.
                texts.append((column[at].as_buffer() or pa.py_buffer(b"")).to_pybytes().split())
                words += len(texts[-1])
                at += 1
            runs = runs_of_texts(texts)
            kept = [_collapsed(t, r) for t, r in zip(texts, runs)]
            yield pa.RecordBatch.from_arrays(
                [
                    keys.slice(first, at - first), pa.array([len(t) for t in texts], pa.int64()), _run_column(runs),
                    pa.array([k.decode("utf-8", "replace") if len(r) else None for k, r in zip(kept, runs)], pa.string()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                ["_key", "n_words", "runs", "collapsed", "collapsed_sha256"],
            )


def find_runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: ``key``, n_words, runs, collapsed, collapsed_sha256.

    ``runs`` lists all runs by start, then period: start (number of the first word), length and
    period in words. ``collapsed`` is the text without the words that a run holds after its first
    period, words joined by a space; it is null where there is no run, as nothing is removed then.
    ``collapsed_sha256`` is that of the joined kept words, in every row.

    Null and empty texts have no words, no runs and the digest of the empty string. Rows need no key,
    and equal rows each give theirs. Other columns are left out. An empty table gives an empty one. Each
    text is looked at by one task, whole; nothing is shuffled. A task holds about CHUNK_WORDS words, or one
    text, and for the longest stretch that may be a run some 400 bytes a word for its two trees.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    out = rows.mapInArrow(_search, f"_key {kind}, n_words long, {RUNS}, collapsed string, collapsed_sha256 string")
    return out.withColumnRenamed("_key", key)



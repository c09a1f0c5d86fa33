"""Self-join of texts by the Jaccard similarity of their word n-grams (operator 1).

Bands of MinHash values propose groups of texts around a leader. Inside a group, two texts'
MinHash values are compared a few at a time, and a pair is dropped as soon as the posterior
probability that its similarity reaches the threshold falls below a tolerance. What is left is
verified on the n-grams themselves. Groups report links per text and a spanning forest, never
their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.components import components
from barloom.llm.storage import return_memory
from barloom.session import written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: 40 bands of 5 values miss a pair of similarity 0.8 with probability 1.2e-7.
BANDS, BAND_VALUES = 40, 5
VALUES = BANDS * BAND_VALUES
#: Posterior probability below which a pair is dropped.
TOLERANCE = 1e-6
#: MinHash values compared between two looks at the posterior.
STEP = 20
#: Texts of a group that one task compares with each other; a larger group is cut into blocks.
BLOCK_TEXTS = 1024

_MULTIPLIERS = np.random.default_rng(20_240_801).integers(1, 1 << 31, VALUES, dtype=np.uint32) * 2 + 1
_OFFSETS = np.random.default_rng(20_240_802).integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)


def shingles(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; fewer words than ``size`` make one n-gram.

    Words are separated by white space. A text without words has no n-grams.
    """
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.uint64)
    grams = zip(*(words[i:] for i in range(size))) if len(words) >= size else [words]
    return np.array(sorted({xxhash.xxh64_intdigest(" ".join(g)) for g in grams}), np.uint64)


def signature(grams: np.ndarray) -> np.ndarray:
    """The MinHash values of a text's n-grams, in bounded memory for any number of them."""
    mixed = ((grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(mixed), 2048):
        part = mixed[i : i + 2048, None] * _MULTIPLIERS[None, :]
        part += _OFFSETS
        part ^= part >> np.uint32(15)
        np.minimum(out, part.min(axis=0), out=out)
    return out


def least_matches(threshold: float, tolerance: float, values: int = VALUES, step: int = STEP) -> list[tuple[int, int]]:
    """(n, m) after every step: a pair with fewer than m of n equal values is dropped.

    With a uniform prior, the posterior after m of n matches is Beta(m + 1, n - m + 1); its mass
    above the threshold is a binomial tail.
    """
    out = []
    for n in range(step, values + 1, step):
        def above(m: int) -> float:
            return sum(comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(m + 1))  # noqa: B023

        out.append((n, next(m for m in range(n + 1) if above(m) >= tolerance)))
    return out


def compare_block(
    left: np.ndarray, right: np.ndarray, allowed: np.ndarray, grams_left: list, grams_right: list, threshold: float, looks: list
) -> np.ndarray:
    """Boolean matrix of the pairs at ``threshold`` or more, of signatures ``left`` and ``right``.

    ``allowed`` marks the pairs to look at. Values are compared step by step on the pairs still
    open; the n-grams of what is left are intersected.
    """
    i, j = np.nonzero(allowed)
    matches = np.zeros(len(i), np.int32)
    done = 0
    for n, least in looks:
        for lo in range(0, len(i), 200_000):
            part = slice(lo, lo + 200_000)
            matches[part] += (left[i[part], done:n] == right[j[part], done:n]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        i, j, matches, done = i[keep], j[keep], matches[keep], n
    out = np.zeros(allowed.shape, bool)
    if not len(i):
        return out
    if len(i) <= 64:
        common = np.array([len(np.intersect1d(grams_left[x], grams_right[y], True)) for x, y in zip(i, j)])
    else:
        common = _common(grams_left, grams_right, i, j)
    union = np.array([len(g) for g in grams_left])[i] + np.array([len(g) for g in grams_right])[j] - common
    # A little slack, so that a similarity of exactly the threshold counts in spite of rounding.
    out[i, j] = common >= threshold * union - 1e-9
    return out


def _common(grams_left: list, grams_right: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (i, j), by products of incidence matrices."""
    used_left, used_right = np.unique(i), np.unique(j)
    parts = [grams_left[x] for x in used_left] + [grams_right[x] for x in used_right]
    owner = np.repeat(np.arange(len(parts)), [len(g) for g in parts])
    _, gram, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    several = count[gram] > 1
    owner, gram = owner[several], gram[several]
    dense = np.unique(gram, return_inverse=True)[1]
    order = np.argsort(dense, kind="stable")
    owner, dense = owner[order], dense[order]
    total = np.zeros((len(used_left), len(used_right)), np.float32)
    width = 4096
    for lo in range(0, int(dense[-1]) + 1 if len(dense) else 0, width):
        a, b = np.searchsorted(dense, (lo, lo + width))
        table = np.zeros((len(parts), width), np.float32)
        table[owner[a:b], dense[a:b] - lo] = 1
        total += table[: len(used_left)] @ table[len(used_left) :].T
    return np.rint(total[np.searchsorted(used_left, i), np.searchsorted(used_right, j)]).astype(np.int64)


def _forest(linked: np.ndarray) -> np.ndarray:
    """Per column node of a symmetric boolean matrix, the least node of its component."""
    n = len(linked)
    root = np.full(n, -1)
    for start in range(n):
        if root[start] >= 0:
            continue
        root[start] = start
        front = np.array([start])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
            root[front] = start
    return root


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return_memory()
    for batch in batches:
        grams = [shingles(t) for t in batch["_text"]]
        yield pd.DataFrame(
            {
                "key": batch["_key"],
                "digest": batch["_digest"],
                "n_grams": [len(g) for g in grams],
                "signature": [signature(g).tobytes() for g in grams],
            }
        )


_MEMBER = "leader bigint, one int, two int, rep bigint, block int, leaders array<bigint>, copies bigint, signature binary, _text string"


def compare_group(group: list[tuple], threshold: float, looks: list) -> list[tuple[int, int, int]]:
    """(rep, root, links) for the linked texts of one group of _MEMBER rows."""
    leader, block_one, block_two = group[0][:3]
    group = sorted({r[3]: r for r in group}.values(), key=lambda r: r[3])
    ids = np.array([r[3] for r in group], np.int64)
    blocks = np.array([r[4] for r in group])
    signatures = np.stack([np.frombuffer(r[7], np.uint32) for r in group])
    grams = [shingles(r[8]) for r in group]
    one, two = np.flatnonzero(blocks == block_one), np.flatnonzero(blocks == block_two)
    if not len(one) or not len(two):
        return []
    allowed = np.ones((len(one), len(two)), bool) if block_one != block_two else ids[one][:, None] < ids[two][None, :]
    # A pair that met around several leaders counts around the least one they share.
    at: dict[int, list[int]] = {}
    for k, r in enumerate(group):
        for x in r[5]:
            if x < leader:
                at.setdefault(x, []).append(k)
    for held in at.values():
        if len(held) > 1:
            mark = np.zeros(len(group), bool)
            mark[held] = True
            allowed &= ~(mark[one][:, None] & mark[two][None, :])
    found = compare_block(
        signatures[one], signatures[two], allowed, [grams[x] for x in one], [grams[x] for x in two], threshold, looks
    )
    linked = np.zeros((len(group), len(group)), bool)
    linked[np.ix_(one, two)] = found
    linked |= linked.T
    links = linked @ np.array([r[6] for r in group], np.int64)
    root = ids[_forest(linked)]
    return [(int(ids[k]), int(root[k]), int(links[k])) for k in np.flatnonzero(linked.any(axis=1))]


def _compare(threshold: float, tolerance: float):
    looks = least_matches(threshold, tolerance)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return_memory()
        rows = (row for b in batches for row in b.itertuples(index=False, name=None))
        done: list[tuple] = []
        for _, group in groupby(rows, key=lambda r: r[:3]):
            done += compare_group(list(group), threshold, looks)
            if len(done) >= 10_000:
                yield pd.DataFrame(done, columns=["rep", "root", "links"])
                done = []
        if done:
            yield pd.DataFrame(done, columns=["rep", "root", "links"])

    return compare


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    digests: bool = False,
) -> DataFrame:
    """One row per input row: ``key``, ``class_id``, ``n_links``, ``n_copies``.

    With ``digests`` also ``digest``, the MD5 of the row's text (a null one counts as empty), and
    ``class_digest``: ``class_id`` and ``class_digest`` together name one text of the class, also
    where a key has several texts.

    Two rows are linked if the Jaccard similarity of their texts' 5-word n-grams is ``threshold``
    or more. ``class_id`` is the least key of a row's connected component, ``n_links`` the number of
    other rows it is linked to, copies of its own text included; ``n_copies`` counts those alone.

    Nulls: null, empty and blank texts have no n-grams and no links, not to each other either; a
    null key is its own class and has no links. Fewer words than five make one n-gram. Repeated
    rows are copies; one key with several texts is a member of each text's class. Empty table: no rows. Other columns are not read.

    Scale: copies of a text are one member, counted with map-side combine. Groups gather around the
    least text of each band bucket; a text joins one group per distinct leader, and a group over
    BLOCK_TEXTS texts is cut into blocks whose pairs are separate tasks. Tasks return a row per
    text, not per pair. No candidate is capped.
    """
    rows = df.select(F.col(key).cast("bigint").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_digest", F.md5(F.col("_text").cast("binary")))
    signed = written(rows.mapInPandas(_sign, "key bigint, digest string, n_grams int, signature binary"), "signatures")
    real = (F.col("n_grams") > 0) & F.col("key").isNotNull()
    light = signed.select("key", "digest", "n_grams")
    texts = light.where(real).groupBy("digest").agg(F.min("key").alias("first_key"), F.count(F.lit(1)).alias("copies"))
    # A text goes by its least key; of several texts with one key, all but one go by a hash below 0.
    nth = F.row_number().over(Window.partitionBy("first_key").orderBy("digest"))
    texts = texts.withColumn("rep", F.when(nth == 1, F.col("first_key")).otherwise(-1 - F.abs(F.xxhash64("digest"))))
    texts = written(texts, "texts")

    named = texts.select("rep", "copies", F.col("first_key").alias("key"), "digest")
    members = signed.join(named, ["key", "digest"]).select("rep", "copies", "key", "digest", "signature")
    keys = F.array(
        *[F.xxhash64(F.substring("signature", 4 * BAND_VALUES * b + 1, 4 * BAND_VALUES), F.lit(b)) for b in range(BANDS)]
    )
    bands = members.select("rep", F.explode(keys).alias("band"))
    buckets = bands.groupBy("band").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last")
    around = written(
        bands.join(buckets, "band").groupBy("rep").agg(F.sort_array(F.collect_set("leader")).alias("leaders")), "leaders"
    )
    each = around.select("rep", "leaders", F.explode("leaders").alias("leader"))
    sizes = each.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).cast("int").alias("blocks"))
    placed = (
        each.join(sizes, "leader")
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("rep", "leaders", "leader", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    )
    full = (
        rows.withColumnsRenamed({"_key": "key", "_digest": "digest"})
        .join(members.join(around.select("rep"), "rep", "left_semi"), ["key", "digest"])
        .dropDuplicates(["key", "digest"])
        .select("rep", "copies", "signature", "_text")
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    result = written(
        placed.join(full, "rep")
        .repartition(parts, "leader", "one", "two")
        .sortWithinPartitions("leader", "one", "two")
        .select("leader", "one", "two", "rep", "block", "leaders", "copies", "signature", "_text")
        .mapInPandas(_compare(threshold, tolerance), "rep bigint, root bigint, links bigint"),
        "links",
    )
    part_of = components(result, "rep", "root")
    grouped = (
        texts.join(result.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
        .join(part_of, F.col("rep") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    least = grouped.groupBy("component").agg(F.min(F.struct("first_key", "digest")).alias("least"))
    per_text = grouped.join(least, "component").select(
        "digest",
        "copies",
        F.col("least.first_key").alias("class_id"),
        F.col("least.digest").alias("class_digest"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )
    # A text that a third of all rows copy is one row here; its join partition is split at run time.
    found = light.join(per_text, "digest", "left")
    linked = F.col("copies").isNotNull() & real
    return found.select(
        F.col("key").alias(key),
        F.when(linked, F.col("class_id")).otherwise(F.col("key")).alias("class_id"),
        F.when(linked, F.col("links") + F.col("copies") - 1).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        F.when(linked, F.col("copies") - 1).otherwise(F.lit(0)).cast("bigint").alias("n_copies"),
        *([F.col("digest"), F.when(linked, F.col("class_digest")).otherwise(F.col("digest")).alias("class_digest")] if digests else []),
    )

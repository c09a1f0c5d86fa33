"""The steps of the repeats' removal, run without Spark: how much is left for the exchange of sorted strings."""

import numpy as np
import pandas as pd
import pytest

from barloom.llm import suffix_dedup
from test_operators import brute_removal, prose

SIZE, GRAM = suffix_dedup.MIN_BYTES, suffix_dedup.GRAM_BYTES


def steps(folder, texts, buckets, rounds=1):
    """What is settled, the sorted runs, and the rows of the result."""
    paths = []
    for i, part in enumerate(np.array_split(np.arange(len(texts)), 2)):
        paths.append(f"{folder}/run-{buckets}-{i}.parquet")
        pd.DataFrame({"_key": part, "_text": [texts[k] for k in part]}).to_parquet(paths[-1])
    settled = []
    for turn in range(rounds):
        entries = suffix_dedup._entries(paths, buckets, SIZE, GRAM, turn, rounds)
        sent = pd.concat(entries(iter([pd.DataFrame({"file": range(len(paths))})])))
        settled += map(suffix_dedup._settle(SIZE), (x for _, x in sent.groupby("bucket")))
    settled = pd.concat(settled)
    left = settled[settled["kind"] == suffix_dedup._OPEN]
    sort = suffix_dedup._sort_open(paths, buckets, SIZE, GRAM)
    runs = pd.concat([sort(x) for _, x in left.groupby(["file", "grp"])])
    merged = pd.concat(map(suffix_dedup._merge_bucket(SIZE), (x for _, x in runs.groupby("bucket"))))
    flags = pd.concat([settled[settled["kind"] == suffix_dedup._FLAG], merged])
    cut = suffix_dedup._cut(paths, False)
    every = pd.DataFrame({"file": range(len(paths)), "grp": None, "data": None})
    got = pd.concat([cut(x) for _, x in pd.concat([flags, every])[["file", "grp", "data"]].groupby("file")])
    rows = got[["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]].astype({"key": str}).itertuples(index=False, name=None)
    return left, runs[runs["kind"] == suffix_dedup._SORTED], sorted(rows)


def windows(left):
    return sum(int(suffix_dedup.unpack(d, ["key", "n"])["n"].sum()) for d in left["data"])


def test_windows_left_open_are_few(tmp_path):
    """20,000 documents share an anchor but nothing around it; three of them share 52 bytes."""
    rng, hasher = np.random.default_rng(5), suffix_dedup.Hasher()
    many = rng.integers(97, 123, 200_000).astype(np.uint8)
    starts = np.arange(len(many) - GRAM)
    least = int(hasher.of(hasher.sums(many), starts, starts + GRAM).argmin())
    texts = rng.integers(97, 123, (20_000, 90)).astype(np.uint8)
    texts[:, 35:55] = many[least : least + GRAM]
    texts[[7, 8000], 20:72] = texts[19_000, 20:72]
    texts = [t.tobytes().decode() for t in texts]
    for buckets in (1, 8, 4096):
        left, runs, got = steps(tmp_path, texts, buckets)
        count = windows(left)
        assert 0 < count < 0.4 * 31 * len(texts)
        assert [r for r in got if r[2]] == [r for r in brute_removal(list(enumerate(texts))) if r[2]]
        if buckets == 4096:
            assert count < 0.05 * 31 * len(texts)


@pytest.mark.parametrize("together", [suffix_dedup._TOGETHER, 4])
def test_sorted_strings_are_small(tmp_path, monkeypatch, together):
    """The ends of a common passage: neighbouring windows go together, those of a common zone are dealt on."""
    monkeypatch.setattr(suffix_dedup, "_TOGETHER", together)
    passage = prose(30, 11)
    texts = [f"{prose(9, i % 150)} {passage} {prose(9, 1000 + i % 130)}" for i in range(300)]
    left, runs, got = steps(tmp_path, texts, 16, 3)
    assert windows(left) > 1000 and got == brute_removal(list(enumerate(texts)))
    if together > 4:
        assert runs["data"].map(len).sum() < 25 * windows(left)
    else:
        assert runs["bucket"].nunique() == 16


def test_rounds_share_the_entries():
    """Every run of windows belongs to one round, and a round is about its share of them."""
    data = np.frombuffer(prose(20_000, 3).encode(), np.uint8)
    hasher, offsets = suffix_dedup.Hasher(), np.array([0, 50_000, 50_010, len(data)])
    whole = hasher.anchors(data, offsets)
    parts = [hasher.anchors(data, offsets, turn, 2) for turn in range(2)]
    for name in whole:
        assert sorted(np.concatenate([p[name] for p in parts]).tolist()) == sorted(whole[name].tolist())
    assert all(0.4 < len(p["pos"]) / len(whole["pos"]) < 0.6 for p in parts)

"""Runs against a search through all periods and places."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import catalog, periodic
from barloom.llm.suffix_tree import Extensions


def plain_runs(s, least=4, shortest=6):
    """All (start, length, period) by start, then period."""
    out, seen = [], {}
    for q in range(1, len(s) // least + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            length = j - i + q
            # A stretch with a smaller period that divides q was found with that one.
            if length >= least * q and (i, length) not in seen:
                seen[i, length] = q
                if length >= shortest:
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(words):
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (len(runs), *best, milli, sha(lines), sha(kept))


def split(text):
    return [w for w in __import__("re").split("[ \t-\r]+", text or "") if w]


def planted(key, words):
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if key is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def some_words(rng, n, letters):
    out = [rng.choice(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 8:
            p, a = rng.randint(1, n // 4), rng.randrange(n)
            z = min(n, a + p * rng.randint(2, 6))
            out[a:z] = [out[a + (i - a) % p] for i in range(a, z)]
    return out


def test_extensions_and_order():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randrange(3) for _ in range(rng.randint(1, 60))]
        s = np.unique(np.array(s), return_inverse=True)[1]
        tree, n = Extensions(s), len(s)
        a, b = (x.ravel() for x in np.meshgrid(np.arange(n + 1), np.arange(n + 1)))
        a, b = a[a != b], b[a != b]
        want = [next((k for k in range(n) if i + k >= n or j + k >= n or s[i + k] != s[j + k]), n) for i, j in zip(a, b)]
        assert tree(a, b).tolist() == want
        assert np.argsort(tree.rank).tolist() == sorted(range(n + 1), key=lambda i: s[i:].tolist())


def test_all_maximal_repetitions():
    rng = random.Random(2)
    for _ in range(1500):
        s = some_words(rng, rng.randint(0, 45), range(rng.randint(1, 4)))
        symbols = np.unique(np.array(s, np.int64), return_inverse=True)[1]
        assert [tuple(r) for r in periodic.all_runs(symbols).tolist()] == plain_runs(s, 2, 2)


@pytest.mark.parametrize("chunk", [1, 50, 1 << 18])
def test_runs_of_many_texts(spark, documents, monkeypatch, chunk):
    monkeypatch.setattr(periodic, "CHUNK_WORDS", chunk)
    rng = random.Random(chunk)
    texts = [some_words(rng, rng.randint(0, 90), ["a", "b", "é", "the", "x y".split()[1]][: rng.randint(1, 5)]) for _ in range(150)]
    rows = [(k, rng.choice([" ", "\n", " \t\r"]).join(t)) for k, t in enumerate(texts)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "a\u00a0a " * 7), (504, "a\u2028a\x1ca " * 7), (None, "w " * 9), (None, "w " * 9)]
    rows += [(505, "a b c d e f"), (506, "a " * 5), (507, "a " * 6), (508, "a b " * 4), (509, "a b " * 3 + "a"), (510, "a b c " * 4 + "a b")]
    df = documents(rows).withColumn("runs", F.lit(1)).withColumn("_key", F.lit(2)).repartition(3)
    got = sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed_sha256"], r["collapsed"] is None) for r in periodic.find_runs(df).collect())
    want = [(str(k), len(split(t)), plain_runs(split(t)), plain_row(split(t))[-1], not plain_runs(split(t))) for k, t in rows]
    assert got == sorted(want)
    kept = {r["doc_id"]: r["collapsed"] for r in periodic.find_runs(df).collect()}
    assert kept[508] == "a b" and kept[509] is None and kept[510] == "a b c"
    assert periodic.find_runs(documents([])).count() == 0


def test_long_texts(spark, documents):
    rng = random.Random(9)
    stretch = [str(rng.randrange(3000)) for _ in range(9000)]
    rows = [(1, " ".join(stretch * 5)), (2, "b " * 120_000), (3, "word" * 500_000), (4, " ".join(str(k) for k in range(100_000)))]
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic.find_runs(documents(rows)).collect()}
    assert (0, 45_000, 9000) in got[1] and got[2] == [(0, 120_000, 1)] and got[3] == [] and got[4] == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in catalog.op13(spark, sf).collect()}
    want = {k: plain_row(planted(k, split(t))) for k, t in docs}
    assert got == want and any(r[0] for r in got.values())


def test_planted_period(spark, documents):
    rows = [(k, "a b  c\td " * (k % 7)) for k in range(60)] + [(None, "a b"), (7, None), (60, "")]
    got = catalog.with_planted_period(documents(rows)).collect()
    assert sorted((str(r["doc_id"]), split(r["text"])) for r in got) == sorted((str(k), planted(k, split(t))) for k, t in rows)

"""Near words, forms and roots against a comparison of all words."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barloom.llm import spelling


def near(a, b):
    """Whether one inserted, deleted or replaced code point tells the words apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (n, len(close), form, counts.get(form))
    return out


def rooted(rows):
    def root(w):
        return w if rows[w][2] is None else root(rows[w][2])

    return {w: (*r, root(w)) for w, r in rows.items()}


def grouped(spark, rows, ratio=10):
    df = spark.createDataFrame(rows, "word string, n long").withColumn("root", F.lit("clash")).repartition(4)
    got = spelling.group_spellings(df, ratio).collect()
    assert len({r["word"] for r in got}) == len(got)
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got}


def words(rng, count, letters, longest):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(count)]


@pytest.mark.parametrize("ranges, cells", [(4 << 20, 1 << 20), (40, 1 << 20), (7, 16), (300, 64)])
def test_equal_to_all_pairs(spark, monkeypatch, ranges, cells):
    monkeypatch.setattr(spelling, "RANGE_CODE_POINTS", ranges)
    monkeypatch.setattr(spelling, "CELLS", cells)
    rng = random.Random(ranges)
    vocabulary = words(rng, 60, "ab", 6) + words(rng, 60, "abß\U0001f600中", 5) + ["a" * 30, "a" * 31, "b" + "a" * 30, "é", ""]
    rows = [(w, rng.choice([1, 1, 2, 5, 12, 130, 1500])) for w in vocabulary] + [("ab", 3), (None, 4), ("zz", None)]
    counts = Counter()
    for w, n in rows:
        if w is not None and n is not None:
            counts[w] += n
    assert grouped(spark, rows) == rooted(plain(counts))


def test_ties_chains_and_long_words(spark):
    long = "ab" * 20_000
    rows = [
        ("aaaaaaa", 2), ("aaaaaab", 20), ("aaaaaac", 20), ("aaaaabb", 200), ("aaaabbb", 2000), ("zaaabbb", 19_999),
        (long, 3), (long + "c", 30), (long[1:], 31), ("c" + long, 30),
    ]
    got = grouped(spark, rows)
    assert got == rooted(plain(dict(rows)))
    assert got["aaaaaaa"][2] == "aaaaaab" and got["aaaaaaa"][4] == "aaaabbb" and got["zaaabbb"][2] is None and got[long][2] == long[1:]


def test_empty_and_refused(spark):
    assert grouped(spark, []) == {} and grouped(spark, [("only", 1)]) == {"only": (1, 0, None, None, "only")}
    with pytest.raises(ValueError):
        spelling.group_spellings(spark.createDataFrame([], "word string, n long"), 1)


def test_one_key_for_every_near_pair(spark):
    rng = random.Random(2)
    rows = [(w, 1) for w in set(words(rng, 150, "ab", 7))]
    _, keys = spelling.dictionary(spark.createDataFrame(rows, "word string, n long"))
    got = spelling.near_words(keys).agg(F.sum("n_near")).first()[0]
    assert got == sum(near(a, b) for a, _ in rows for b, _ in rows)


def test_vocabulary(spark, documents):
    rows = [
        (1, "Straßenbahn STRAßENBAHN straÀenbahn short wordlike_wordlike"), (2, None), (3, ""), (None, "wordlike STRAßENBAHN"),
        (4, "X" * 50_000 + " " + "x" * 50_000), (5, "x" * 50_000), (6, "Àbcdefg àbcdefg Àbcdefg"), (6, "Àbcdefg"), (7, "abc defghij1abcdefg×hijklmnop"),
    ] + [(k, "frequent " * 3) for k in range(10, 200)]
    want = Counter()
    for k, t in rows:
        for run in __import__("re").findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            want[w] += 1
    want = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    df = documents(rows).withColumn("word", F.lit("clash")).withColumn("_id", F.lit(1))
    assert {r["word"]: r["n"] for r in spelling.vocabulary(df).collect()} == want
    assert any(len(w) == 7 and w.startswith("fr") for w in want)

"""Matches, shards, packages and clashing names: cases beside those of test_operators."""

import gzip
import io
import json
import random
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from barloom.llm import archive, catalog, decontaminate, hilbert, ngram_join, quality, secrets, toxicity
from barloom.session import new_folder
from test_operators import prose


def distances(pattern, text):
    """Least edits of the pattern against a part of the text that ends at each place."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row


def plain_ends(pattern, text, errors):
    """The ends of the valleys of the distances within the bound, the first of equally deep places."""
    row, out = distances(pattern, text), []
    j = 0
    while j <= len(text):
        if row[j] > errors:
            j += 1
            continue
        k = j
        while k <= len(text) and row[k] <= errors:
            k += 1
        part = row[j:k]
        i = 0
        while i < len(part):
            best = i
            while i + 1 < len(part) and part[i + 1] <= part[i]:
                i += 1
                best = i if part[i] < part[best] else best
            out.append((j + best, part[best]))
            while i + 1 < len(part) and part[i + 1] >= part[i]:
                i += 1
            i += 1
        j = k
    return out


def test_every_valley_of_distances_is_a_match():
    rng = random.Random(4)
    for _ in range(600):
        pattern = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("ab") for _ in range(rng.randint(0, 50)))
        errors = rng.randint(0, 3)
        assert decontaminate.best_matches(pattern, text, errors) == plain_ends(pattern, text, errors)


def test_all_matches_of_all_items(spark, documents):
    """Against the distances of every item in every text, overlapping and edited occurrences included."""
    rng = random.Random(8)
    items = [(k, decontaminate.normalise(prose(10, k))) for k in range(4)] + [(5, "ab ab ab ab ab ab ab ab ab ab ab"), (6, "short item"), (7, "é")]
    texts = []
    for _ in range(40):
        words = prose(30, rng.random()).split()
        item = rng.choice(items)[1]
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(item))
            item = item[:at] + rng.choice(["", "z", item[at] + "z"]) + item[at + 1 :]
        words[rng.randrange(30) : rng.randrange(30)] = [item]
        texts.append(" ".join(words))
    texts += ["ab " * 30, "x short item", "short items", "shortitem", "é", "né é!", None, "", texts[0]]
    rows = list(enumerate(texts)) + [(None, texts[0])]
    df = documents(rows).withColumn("begin", F.lit("clash")).withColumn("_key", F.lit("clash"))
    got = decontaminate.find_leaks(df, items).select("doc_id", "item_id", "end", "distance").collect()
    want = []
    for k, t in rows:
        text = decontaminate.normalise(t)
        for i, item in items:
            for end, d in plain_ends(item, text, int(len(item) * 0.05)) if text else []:
                alone = decontaminate._stands_alone(text, end - len(item), end)
                if end and (len(item) >= decontaminate.MIN_CHARS or alone):
                    want.append((k, i, end, d))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    # A short item is found, but is no reason to drop a document.
    kept = decontaminate.without_leaks(documents([(1, "x short item"), (2, items[0][1])]), items)
    assert [r["doc_id"] for r in kept.collect()] == [1]
    assert decontaminate.find_leaks(documents([]), items).count() == 0 == decontaminate.without_leaks(documents([]), items).count()


def test_whole_texts_order_the_curve(spark):
    rows = [(k, f"https://host-{k % 20:02d}.example/{k}", float(k % 7)) for k in range(2000)] + [(None, None, None), (None, "https://", 1.0), (3, "x", None)] * 2
    df = spark.createDataFrame(rows, "k long, url string, n double").repartition(3)
    cuts = hilbert.quantile_cuts(df, ["url", "n"], 3)
    assert len(cuts[0]) == 7 and len(set(cuts[0])) == 7 and cuts[0] == sorted(cuts[0])
    placed = hilbert.hilbert_shards(df, "k", ["url", "n"], 16)
    ranges = hilbert.shard_ranges(placed, ["url", "n"]).collect()
    assert sum(r["n_rows"] for r in ranges) == len(rows) and len(ranges) == 16
    # A reader of one host opens few shards; dealt at random, it would open them all.
    hits = [sum(r["min_url"] <= f"https://host-{h:02d}.example/z" and r["max_url"] >= f"https://host-{h:02d}.example/" for r in ranges) for h in range(20)]
    assert sum(hits) / 20 < 8
    cells = hilbert._cell(F.col("url"), ["b", "d"])
    got = spark.createDataFrame([(x,) for x in (None, "", "b", "ba", "d", "da")], "url string").select(cells).collect()
    assert [r[0] for r in got] == [0, 0, 0, 1, 1, 2]


def test_text_cuts_count_every_row(spark):
    rows = [(f"k{i * i % 9973:05d}" if i % 3 else "k00500", None if i % 10 == 0 else f"é{i % 4}", float(i)) for i in range(40_000)] + [(None, None, None)] * 50
    df = spark.createDataFrame(rows, "a string, b string, n double").repartition(5)
    got = hilbert.quantile_cuts(df, ["b", "n", "a"], 4)
    for cuts, column in ((got[2], 0), (got[0], 1)):
        values = sorted(r[column] for r in rows if r[column] is not None)
        assert cuts == [values[len(values) * k // 16] for k in range(1, 16)]
    assert hilbert.quantile_cuts(df.select("a", "b", F.lit(None).cast("string").alias("c")).where("a IS NULL"), ["c", "a"], 4) == [[], []]


def test_shard_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = catalog.op2(spark, sf).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {k: (len(t.encode()) + 16, zlib.crc32(t.encode())) for k, t in texts.items()}
    assert len(got) == len(texts) and all(r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 40 for r in got)


def test_helper_names_are_refused(spark, documents):
    df = documents([(1, "token = 0123456789abcdef"), (2, None), (2, None)])
    for name in ("_body", "_words", "_lines", "spans", "_row"):
        extra = df.withColumn(name, F.lit("clash"))
        assert quality.quality_measures(extra).where(F.col(name) == "clash").count() == 3
        masked = secrets.redact_live(extra)
        assert masked.columns == extra.columns and masked.where(F.col(name) == "clash").count() == 3
    for fn, name in ((quality.quality_measures, "_quality_body"), (secrets.redact_live, "_secret_row")):
        with pytest.raises(ValueError):
            fn(df.withColumn(name, F.lit(1)))
    assert secrets.redact_live(documents([])).count() == 0


def warc(kind, ident, payload, http=True):
    block = (b"HTTP/1.1 200 OK\r\nServer:x\r\n\r\n" if http else b"") + payload
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{ident}>\r\nContent-Type: {'application/http' if http else 'text/plain'}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def test_packages_of_other_writers(spark, tmp_path):
    one = [gzip.compress(warc("response", k, f"<p>{k}</p>".encode())) for k in range(3)]
    two = [warc("resource", 9, b"plain", http=False), warc("revisit", 10, b"")]
    lines = {"a.warc.gz": one, "b.warc": two}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("pages/pages.jsonl", b"x" * 1000, zipfile.ZIP_DEFLATED)
        z.writestr("archive/a.warc.gz", b"junk" + b"".join(one))
        z.writestr("archive/b.warc", b"".join(two))
        for ending, (name, records) in zip(("cdx.gz", "cdxj"), lines.items()):
            at, text = 4 if name == "a.warc.gz" else 0, []
            for r in records:
                text.append(f"com,example)/ 2020 {json.dumps({'filename': name, 'offset': str(at), 'length': str(len(r))})}")
                at += len(r)
            data = ("!meta\n" + "\n".join(text) + "\n").encode()
            z.writestr(f"indexes/{name}.{ending}", gzip.compress(data) if ending.endswith("gz") else data)
        z.writestr("datapackage.json", b"{}" * 100, zipfile.ZIP_DEFLATED)
    folder = new_folder(spark, "foreign")
    path = folder.removeprefix("file:")
    import os

    os.makedirs(path)
    with open(f"{path}/x.wacz", "wb") as f:
        f.write(out.getvalue())
    manifest = spark.createDataFrame([("x.wacz", 5)], "file string, n_records long")
    got = sorted((r["record_type"], None if r["payload"] is None else bytes(r["payload"]), r["payload_bytes"], r["page"]) for r in archive.read_archives(spark, folder, manifest).collect())
    assert got == sorted([("resource", b"plain", 5, None), ("revisit", None, 0, None)] + [("response", f"<p>{k}</p>".encode(), 8, None) for k in range(3)])
    empty = io.BytesIO()
    with zipfile.ZipFile(empty, "w") as z:
        z.writestr("a.warc.gz", b"")
    from test_operators import Bytes

    with pytest.raises(ValueError):
        list(archive.record_places(Bytes(empty.getvalue())))


def test_weights_minimise_the_stated_loss():
    """The gradient of log loss, weight decay and twin penalty is nearly zero at the weights found."""
    import numpy as np

    rng = random.Random(6)
    texts, y = [], []
    for k in range(300):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(12)]
        words += ["vile"] * (k % 3 == 0) + ["women"] * (rng.random() < (0.7 if k % 3 == 0 else 0.2))
        texts.append(" ".join(words))
        y.append(int(k % 3 == 0))
    weights = [1.0 + (k % 2) for k in range(300)]
    s = toxicity.Settings(counterfactual=3.0, steps=30000)
    model = toxicity.train(texts, y, weights, s)
    names = [f for f in model if f]

    def vector(counter):
        f = toxicity.feature_counts(counter)
        return np.array([np.log1p(f[n]) for n in names])

    counted = [toxicity.word_counts(t) for t in texts]
    x = np.array([vector(c) for c in counted])
    w = np.array([model[n] for n in names])
    p = 1 / (1 + np.exp(-(x @ w + model[""])))
    r = np.array(weights) * (p - np.array(y))
    grad = x.T @ r + s.l2 * w
    for c, u in zip(counted, weights):
        if (twin := toxicity.swapped(c)) is not None:
            d = vector(c) - vector(twin)
            grad += s.counterfactual * u * (d @ w) * d
    assert np.abs(grad).max() < 1e-3 and abs(r.sum()) < 1e-3, (grad, r.sum(), model)


def test_toxicity_of_odd_tables(spark, documents):
    rows = [(k, prose(12, k) + (" vermin" if k % 2 else ""), "s") for k in range(120)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(120)] + [(3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    docs = documents(rows + rows[:10] + [(None, "vermin"), (7, None)]).withColumn("_key", F.lit(1)).withColumn("score", F.lit("clash"))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model)
    assert scored.count() == 132 and dict(scored.dtypes)["score"] == "double"
    assert scored.where("doc_id = 11 AND score < 0.5").count() == 0
    assert toxicity.score(documents([]), model).count() == 0
    report = toxicity.penalty_report([t for _, t, _ in rows] + ["women are here", "muslims and women"], [k % 2 for k in range(120)] + [0, 0])
    assert report["twins"] == 2 and report["gap"] <= report["gap_without"] + 1e-9


def test_null_keys_of_near_duplicates(spark, documents):
    text = prose(40, 1)
    got = ngram_join.near_duplicates(documents([(None, text), (None, text), (1, text)])).collect()
    assert len(got) == 3

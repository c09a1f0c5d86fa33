"""The training-data operators against brute force on small fixtures with awkward rows."""

import hashlib
import io
import random
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import archive, decontaminate, hilbert, ngram_join, pieces, quality, records, secrets, suffix_dedup, toxicity
from barloom.llm.checksum import crc32c_many
from barloom.llm.loser_tree import front_code, merge
from barloom.llm.storage import open_store
from barloom.session import new_folder

public = pytest.importorskip("public_tokenizers")
RNG = random.Random(7)
WORDS = ["alpha", "beta", "gamma", "delta", "one", "two", "three", "four", "five", "the", "of", "é", "▁x"]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


LONG = prose(30_000, 1)
ROWS = [
    (1, prose(120, 2)), (2, prose(120, 2)), (3, prose(60, 2) + " " + prose(60, 3)), (4, None), (5, ""), (6, "  \n "),
    (7, "only three words"), (8, "only three words"), (9, LONG), (10, LONG + " end"), (None, prose(120, 2)), (11, prose(115, 2)),
    (11, prose(115, 2)), (12, "x" * 49), (13, "x" * 50), (14, "x" * 51), (15, "naïve \U0001f600 " * 20), (16, "naïve \U0001f600 " * 20),
]


def jaccard(a, b):
    x, y = set(ngram_join.shingles(a).tolist()), set(ngram_join.shingles(b).tolist())
    return len(x & y) / len(x | y) if x and y else 0.0


def test_ngram_join(spark, documents):
    got = ngram_join.near_duplicates(documents(ROWS).withColumn("rep", F.lit("clash"))).collect()
    assert len(got) == len(ROWS)
    want = []
    for i, (k, t) in enumerate(ROWS):
        linked = [j for j, (q, u) in enumerate(ROWS) if j != i and k is not None and q is not None and jaccard(t, u) >= 0.8]
        want.append((str(k), len(linked)))
    assert sorted((str(r["doc_id"]), r["n_links"]) for r in got) == sorted(want)
    classes = {r["doc_id"]: r["class_id"] for r in got}
    assert classes[2] == 1 and classes[11] == 1 and classes[10] == 9 and classes[3] == 3 and classes[8] == 7 and classes[5] == 5
    assert ngram_join.near_duplicates(documents([])).count() == 0


def test_large_near_group_is_cut_into_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 8)
    base = prose(200, 5).split()
    rows = []
    for i in range(40):
        words = list(base)
        words[5 * i] = f"changed{i}"
        rows.append((100 + i, " ".join(words)))
    got = {r["doc_id"]: r for r in ngram_join.near_duplicates(documents(rows)).collect()}
    for k, t in rows:
        assert got[k]["n_links"] == sum(q != k and jaccard(t, u) >= 0.8 for q, u in rows)
        assert got[k]["class_id"] == 100


def test_posterior_keeps_what_it_must():
    looks = ngram_join.least_matches(0.8, 1e-6)
    assert all(a[1] <= b[1] for a, b in zip(looks, looks[1:])) and looks[-1][1] < 0.8 * ngram_join.VALUES


def test_hilbert_shards(spark):
    rows = [(i, None if i % 11 == 0 else f"s{i % 5 if i % 3 else 0}", None if i % 13 == 0 else i % 97) for i in range(1000)] + [(5, "s0", 5)] * 3
    df = spark.createDataFrame(rows, "k long, a string, b long").withColumn("shard", F.lit("clash"))
    got = hilbert.hilbert_shards(df, "k", ["a", "b"], 7).collect()
    sizes = {}
    for r in got:
        sizes.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == len(rows) and set(sizes) == set(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in order] == sorted(r["curve"] for r in got)
    assert hilbert.hilbert_shards(df.limit(0), "k", ["a", "b"], 7).count() == 0


def test_hilbert_index_steps_to_neighbours(spark):
    cells = spark.range(512).select(*[F.expr(f"cast((id div {8**i}) % 8 as int)").alias(f"c{i}") for i in range(3)])
    path = sorted((r["h"], r["c0"], r["c1"], r["c2"]) for r in cells.withColumn("h", hilbert.hilbert_index([F.col(f"c{i}") for i in range(3)], 3)).collect())
    assert [p[0] for p in path] == list(range(512))
    assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:])) == 1 for p, q in zip(path, path[1:]))


def test_pieces_equal_the_library(spark, documents):
    import sentencepiece

    path = public.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = ROWS + [(20, "a  b\n c"), (21, " lead"), (22, "中文 \0 z"), (23, " " * 70 + "k"), (24, "<s> <0x0A>")]
    got = pieces.encode_documents(documents(odd).withColumn("ids", F.lit(1)), path).collect()
    want = sorted((str(k), library.encode(t or "")) for k, t in odd)
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in got) == want
    assert all(r["round_trip"] or "▁" in t for r in got for k, t in odd if k == r["doc_id"] and t)
    assert pieces.encode_documents(documents([]), path).count() == 0


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_edit_distance_and_leaks(spark, documents):
    rng = random.Random(3)
    for _ in range(200):
        pattern = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 30)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 60)))
        best, want = decontaminate.best_match(pattern, text, 5), plain_distance(pattern, text)
        assert (best is None) == (want > 5) and (best is None or best[1] == want)
    item = prose(25, 9)
    edited = item[:40] + "Z" + item[41:90] + item[91:]
    broken = item[: len(item) // 2]
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "short")], "item_id long, text string")
    items = decontaminate.benchmark_items(bench)
    assert [i for i, _ in items] == [1, 4]
    rows = [(1, "a " + item.upper() + " b"), (2, "x " + edited), (3, broken), (4, None), (5, ""), (6, item + " " + LONG + " " + item)]
    docs = documents(rows)
    got = sorted((r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.find_leaks(docs, items).collect())
    assert got == [(1, 1, 0), (2, 1, 2), (6, 1, 0), (6, 1, 0)]
    assert sorted(r["doc_id"] for r in decontaminate.without_leaks(docs, items).collect()) == [3, 4, 5]
    many = items + [(k, prose(25, k)) for k in range(10, 15)]
    assert decontaminate.find_leaks(docs, many, block_chars=200).count() == 4
    assert decontaminate.find_leaks(docs, []).count() == 0 and decontaminate.without_leaks(docs, []).count() == 6


def brute_repeats(words):
    grams = {}
    for i in range(len(words) - 4):
        grams.setdefault(tuple(words[i : i + 5]), []).append(i)
    return len({i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)})


def test_quality_measures(spark, documents):
    import re

    texts = [None, "", " \t\x0b", "a b c d e a b c d e", "w " * 30, "x\n\nx\n x\ny#*", "é é <a> | b", LONG]
    texts += [" ".join(RNG.choice("ab") for _ in range(40)) for _ in range(10)]
    got = quality.apply_rules(quality.quality_measures(documents(list(enumerate(texts))).withColumn("n_words", F.lit("clash")))).collect()
    for r in got:
        t = texts[r["doc_id"]] or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        want = (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), brute_repeats(words))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["passes"] == (not r["failed_rules"])
    assert quality.quality_measures(documents([])).count() == 0


def brute_spans(text):
    import re

    kinds = (
        ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 18),
        ("hex", r"[0-9a-f]+", 0, 16),
    )
    found = [(m.start(), n, k[0], m.end()) for n, k in enumerate(kinds) for m in re.finditer(k[1], text or "") if len(m[k[2]]) >= k[3]]
    return ",".join(f"{k}:{a}:{z}" for a, _, k, z in sorted(found))


def test_secrets(spark, documents):
    live, copied, vendor = "0123456789abcdef" * 2, "fedcba9876543210" * 2, "ghp_" + "Ab3" * 8
    rows = [
        (1, f"é token = '{live}' end", "a/x"), (2, f"TOKEN: {copied}", "a/x"), (3, f"api_key={copied}", "b/x"), (4, f"hex {copied}", "c/x"),
        (5, "secret=token: abcdefghijklmnop AKIA" + "Q" * 14, "d"), (6, None, "d"), (7, "", None), (8, "password: short", "d"),
        (9, vendor, "e/1"), (10, f"{vendor} AKIAAKIA" + "1" * 12 + f" {live}", "a/y"), (10, f"hex {copied}", "c/x"),
        (11, LONG + " Passwd=" + "k" * 12, "f"),
    ]
    found = secrets.scan_secrets(documents(rows))
    base = [k.name for k in secrets.BASE_KINDS]
    listed = found.select("doc_id", secrets.span_list(F.filter("spans", lambda s: s["kind"].isin(*base))).alias("s")).collect()
    assert sorted((r["doc_id"], r["s"]) for r in listed) == sorted((k, brute_spans(t)) for k, t, _ in rows)
    flags = {(r["doc_id"], s["kind"], s["live"]) for r in found.collect() for s in r["spans"]}
    assert (1, "hex", True) in flags and (4, "hex", False) in flags and (9, "vendor", True) in flags
    masked = {r["doc_id"]: r["text"] for r in secrets.redact_live(documents(rows)).where("doc_id IN (1, 4, 6, 8)").collect()}
    assert live not in masked[1] and masked[1].startswith("é ") and copied in masked[4] and masked[6] is None and masked[8] == "password: short"
    assert secrets.redact_live(documents(rows)).count() == len(rows) and secrets.scan_secrets(documents([])).count() == 0


def test_archives(spark):
    rows = [(1, "u", "<p>é</p>"), (2, "u", "<p>é</p>"), (3, None, None), (4, "u\r\nx", ""), (5, "u", "a" * 100_000), (None, "u", "a" * 100_000), (5, "u", "a" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    folder = new_folder(spark, "archives")
    back = archive.read_archives(spark, folder, archive.write_archives(pages, folder)).collect()
    assert sorted((str(r["page"]), r["record_type"], r["refers_to"]) for r in back) == sorted(
        [("1", "response", None), ("2", "revisit", 1), ("3", "response", None), ("4", "revisit", 3), ("5", "response", None), ("5", "response", None), ("None", "revisit", 5)]
    )
    for r in back:
        html = next((h or "" for k, _, h in rows if k == r["page"]), "").encode()
        assert r["payload_bytes"] == len(html) and r["payload_digest"] == archive.payload_digest(html)
        assert r["payload"] is None or bytes(r["payload"]) == html
    assert archive.archive_round_trip(pages.limit(0)).count() == 0
    apart = archive.archive_round_trip(pages, least=50)
    assert apart.where("record_type = 'revisit'").count() == 1


class Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at : at + n]


def test_zip_directory():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.comment = b"PK\x05\x06 in a comment"
        z.writestr("dir/", b"")
        with z.open(zipfile.ZipInfo("a.bin"), "w", force_zip64=True) as m:
            m.write(b"first")
        z.writestr("b.bin", b"second")
    f = Bytes(out.getvalue())
    assert [(m.name, f.read_at(m.size, m.begin)) for m in archive.zip_members(f)] == [("a.bin", b"first"), ("b.bin", b"second")]
    # The same archive with its end record at the limits, so that the ZIP64 one holds.
    data = bytearray(out.getvalue())
    end = data.index(b"PK\x05\x06")
    count, length, at = struct.unpack_from("<HII", data, end + 10)
    wide = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, length, at)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, end, 1)
    tail = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    f = Bytes(bytes(data[:end]) + wide + locator + tail)
    assert [m.name for m in archive.zip_members(f)] == ["a.bin", "b.bin"]
    squeezed = io.BytesIO()
    with zipfile.ZipFile(squeezed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("c", b"x" * 100)
        z.writestr(zipfile.ZipInfo("d"), b"stored")
    assert [m.name for m in archive.zip_members(Bytes(squeezed.getvalue()))] == ["d"]
    for bad in (b"", b"no archive"):
        with pytest.raises(ValueError):
            archive.zip_members(Bytes(bad))


def test_records(spark, documents):
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = ROWS + [
        (30, "a   b \n  c\t"), (31, "<|endoftext|>"), (32, "nul \0 nul"), (33, "a <|endoftext|> b"), (34, "a<|endoftext|>b <|EndOfText|> <|end"),
    ]
    folder = new_folder(spark, "records")
    manifest = records.write_records(documents(rows).withColumn("key", F.lit(0)), path, folder)
    got = sorted(records.read_records(spark, folder, manifest).collect(), key=lambda r: r["start"])
    order = sorted(((k is not None, k or 0, t or "") for k, t in rows))
    start = 0
    for r, (has, k, t) in zip(got, order):
        want = tokenizer.encode(t, add_special_tokens=False).ids + [0]
        assert (r["key"], r["start"], list(r["ids"])) == (k if has else None, start, want)
        start += len(want)
    assert len(got) == len(order)
    digest = records.records_round_trip(documents(rows), path).where("doc_id = 5").first()
    assert (digest["n_tokens"], digest["ids_crc32"]) == (1, zlib.crc32(b"\0\0\0\0"))
    assert records.records_round_trip(documents([]), path).count() == 0
    data, offsets = records.frame([b"abc", b""])
    damaged = data[:13] + bytes([data[13] ^ 1]) + data[14:]
    assert records.unframe(data, offsets) == [b"abc", b""]
    with pytest.raises(ValueError):
        records.unframe(damaged, offsets)


def test_crc32c():
    assert crc32c_many(np.frombuffer(b"123456789", np.uint8), [0, 0, 3], [9, 0, 1]).tolist()[:2] == [0xE3069283, 0]


def test_toxicity(spark, documents):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [rng.choice(WORDS) for _ in range(30)]
        if toxic:
            words += ["vermin", "filth"]
        # Toxic sentences name the group more often, so a plain model learns to dislike the name.
        if rng.random() < (0.8 if toxic else 0.1):
            words.append("muslims")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    labels += [(0, 1), (None, 1), (1, None), (9999, 1)]
    docs = documents(rows + [(1000, None), (1001, ""), (None, "vermin filth")])
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(got) == 603 and all(0 <= s <= 1 for s in got.values())
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in held)
    texts, y = [t for _, t in rows], [int(i % 4 == 0) for i in range(600)]
    plain = toxicity.train(texts, y, settings=toxicity.Settings(counterfactual=0.0))
    fair = toxicity.train(texts, y, settings=toxicity.Settings(counterfactual=20.0))
    change = lambda m: abs(toxicity.score_text(m, "alpha muslims beta") - toxicity.score_text(m, "alpha christians beta"))
    assert change(fair) < 0.3 * change(plain)
    assert toxicity.train([], []) == {"": 0.0}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, none)).where("score <> 0.5").count() == 0


def brute_removal(rows):
    first = {}
    last = 1 << 62
    for k, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            s = b[p : p + 50]
            first[s] = min(first.get(s, last), last if k is None else k)
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (last if k is None else k):
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((str(k), len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup(spark, documents):
    passage = prose(30, 11)
    rows = ROWS + [(40 + i, prose(9, 50 + i) + passage + prose(9, 80 + i)) for i in range(12)]
    rows += [(60, "For " * 200), (61, "For " * 100 + "\0" * 60), (62, "\0" * 55), (40, passage), (-5, passage[10:90])]
    for parts in (1, 5):
        got = suffix_dedup.remove_repeats(documents(rows).repartition(parts).withColumn("grp", F.lit(1))).collect()
        names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert sorted((str(r["doc_id"]), *[r[n] for n in names]) for r in got) == brute_removal(rows)
    kept = suffix_dedup.remove_repeats(documents([(1, passage), (2, "new " + passage)]), content=True).where("doc_id = 2").first()
    assert bytes(kept["kept"]) == b"new " and (list(kept["begins"]), list(kept["ends"])) == ([4], [4 + len(passage.encode())])
    assert suffix_dedup.remove_repeats(documents([])).count() == 0


def test_equal_hashes_mean_equal_bytes():
    """50,000 texts of one window around one anchor, a string of a very small hash, are told apart."""
    rng, hasher = np.random.default_rng(3), suffix_dedup.Hasher()
    many = rng.integers(97, 123, 200_000).astype(np.uint8)
    starts = np.arange(len(many) - 20)
    least = int(hasher.of(hasher.sums(many), starts, starts + 20).argmin())
    texts = rng.integers(97, 123, (50_000, 50)).astype(np.uint8)
    texts[:, 15:35] = many[least : least + 20]
    found = hasher.anchors(texts.ravel(), np.arange(0, texts.size + 1, 50))
    assert len(found["pos"]) == len(texts) and (found["key"] == found["key"][0]).mean() > 0.99
    assert len({(k, j) for k, j in zip(found["key"].tolist(), found["joint"].tolist())}) == len(texts)


def test_loser_tree():
    rng = np.random.default_rng(2)
    for k in (1, 2, 3, 7):
        runs, every = [], []
        for run in range(k):
            strings = sorted(bytes(rng.integers(97, 99, 6).astype(np.uint8)) for _ in range(rng.integers(0, 30)))
            every += [(s, run) for s in strings]
            common, rest = front_code(np.frombuffer(b"".join(strings), np.uint8).reshape(-1, 6))
            runs.append((common.tolist(), rest, strings))
        out = [(runs[r][2][i], r, c) for r, i, c in merge([x[:2] for x in runs], 6)]
        assert [(s, r) for s, r, _ in out] == sorted(every)
        for (a, _, _), (b, _, c) in zip(out, out[1:]):
            assert c == next((i for i in range(6) if a[i] != b[i]), 6)


def test_local_paths():
    assert open_store("file:///a/b")[1] == "/a/b" and open_store("file:/a")[1] == "/a" and open_store("/a/b")[1] == "/a/b"

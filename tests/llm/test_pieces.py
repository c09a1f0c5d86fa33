"""Long words, bounded memories, decoding and refused models of the piece encoder."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import pieces

public = pytest.importorskip("public_tokenizers")
PATH = public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def letters(rng, n, of):
    return "".join(rng.choice(of) for _ in range(n))


@pytest.mark.parametrize("stretch, overlap, index", [(4096, 256, 250_000), (40, 24, 100), (64, 17, 5000), (33, 33, 1)])
def test_long_words_equal_the_library(library, monkeypatch, stretch, overlap, index):
    monkeypatch.setattr(pieces, "STRETCH", stretch)
    monkeypatch.setattr(pieces, "OVERLAP", overlap)
    monkeypatch.setattr(pieces, "INDEX_CHARS", index)
    rng = random.Random(stretch)
    encoder = pieces.Encoder(pieces.load_model(PATH))
    size = 6000 if stretch == 4096 else 700
    texts = [
        letters(rng, size, "etaoinshrdlu"), letters(rng, size, "aab"), "a" * (size + 1), "ba" * size, "international" * (size // 5),
        letters(rng, size, "中文字符是的了在不人有\U0001f600é"), letters(rng, size, "ABCDEFGHabcdefgh0123456789+/") + " end", "=" * size + "é" + "-" * size,
    ]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library.encode(text)
    assert max(map(len, encoder.words)) <= stretch


def test_a_text_of_five_million_characters_without_a_blank(spark, documents, library):
    rng = random.Random(4)
    block = letters(rng, 50_000, "etaoinshrdlucmfw")
    text = "".join(block[rng.randrange(40_000) :][:10_000] for _ in range(500))
    assert len(text) == 5_000_000
    got = pieces.encode_documents(documents([(1, text), (2, "short")]), PATH).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in got} == {1: library.encode(text), 2: library.encode("short")}
    assert all(r["round_trip"] for r in got)


def test_words_are_remembered_in_bounded_bytes(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 20_000)
    rng = random.Random(5)
    encoder = pieces.Encoder(pieces.load_model(PATH))
    for _ in range(60):
        texts = [" ".join(letters(rng, 6, "abcdef") for _ in range(20)) + " the same words" for _ in range(2)]
        assert [x.tolist() for x in encoder.encode(texts)] == [library.encode(t) for t in texts]
        assert len(encoder.words) + len(encoder.older) < 400 and pieces.MARK + "same" in encoder.words


def test_decoding(spark, library):
    texts = ["plain words", "", " lead  and  more ", "naïve 中文 \U0001f600\n", "▁mark", "tail "]
    rows = [(k, t, library.encode(t)) for k, t in enumerate(texts)] + [(90, None, None), (91, "", []), (92, "a", [None, *library.encode("a")])]
    df = spark.createDataFrame(rows, "k long, text string, ids array<int>").repartition(2)
    got = {r["k"]: r for r in pieces.decode_ids(df, PATH, out="back").collect()}
    assert {k: got[k]["back"] for k, _, _ in rows} == {k: None if t is None else t.replace("▁mark", " mark") for k, t, _ in rows}
    assert all(got[k]["back"] == library.decode(ids) for k, t, ids in rows if k < 90)
    assert set(pieces.decode_ids(df, PATH).columns) == {"k", "text", "ids"}
    assert pieces.decode_ids(df.limit(0), PATH).count() == 0
    split = spark.createDataFrame([(library.encode("é\U00010348")[:-1],)], "ids array<int>")
    assert "�" in pieces.decode_ids(split, PATH).first()["text"]
    with pytest.raises(Exception, match="outside the vocabulary"):
        pieces.decode_ids(spark.createDataFrame([([10**6],)], "ids array<int>"), PATH).collect()


def test_other_models_are_refused():
    field = lambda n, data: bytes([n << 3 | 2, len(data)]) + data
    flag = lambda n, value: bytes([n << 3, value])
    fine = field(2, flag(3, 2)) + field(3, field(1, b"identity") + flag(4, 0))
    pieces._refuse_other_models(fine)
    for trainer, normalizer in [
        (flag(3, 1), field(1, b"identity") + flag(4, 0)), (flag(3, 2), field(1, b"nmt_nfkc") + flag(4, 0)), (flag(3, 2), field(1, b"identity")),
        (flag(3, 2), field(1, b"identity") + flag(4, 0) + flag(3, 0)), (flag(3, 2), field(2, b"map") + flag(4, 0)),
    ]:
        with pytest.raises(ValueError):
            pieces._refuse_other_models(field(2, trainer) + field(3, normalizer))
    assert np.array([len(p) for p in pieces.load_model(PATH).pieces]).max() > 1

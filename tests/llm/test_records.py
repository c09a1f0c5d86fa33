"""Ids of a worker's remembered words against the library's own, text by text."""

import random

import numpy as np
import pytest

from barloom.llm import records

public = pytest.importorskip("public_tokenizers")
PIECES = ["alpha", "beta,", "é", "中文", "x\ny", "\n", "\t", "", "", "'s", "12", "a" * 300, "#$%", " ", " z", "\0", "it's", "😀", "end.\n"]


@pytest.fixture()
def tokens():
    records.worker_state("tokenizers").clear()
    yield records.load_tokenizer(public.path("byte_bpe_50k.json"))
    records.worker_state("tokenizers").clear()


def odd_texts(seed, n=400):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(PIECES) + str(rng.randint(0, 9)) * rng.randint(0, 1) for _ in range(rng.randint(0, 12))) for _ in range(n)]
    return texts + ["", " ", "  ", " a", "a ", "a  b", "\n a", "<|endoftext|> a", "a"]


def plain(tokens, texts):
    return [np.asarray(tokens.tokenizer.encode(t, add_special_tokens=False).ids, tokens.dtype).tobytes() for t in texts]


def test_remembered_ids_equal_the_library(tokens, monkeypatch):
    for seed in range(4):
        texts = odd_texts(seed)
        assert records.encode_texts(texts, tokens) == plain(tokens, texts)
    known = len(tokens.words.number)
    assert records.encode_texts(odd_texts(3), tokens) == plain(tokens, odd_texts(3)) and len(tokens.words.number) == known
    # A memory that is full is cleared and filled anew.
    monkeypatch.setattr(records, "MAX_REMEMBERED", 10)
    assert records.encode_texts(["beta", "x y beta"], tokens) == plain(tokens, ["beta", "x y beta"])
    assert sorted(tokens.words.number) == [" beta", " x", "beta", "x", "y"]
    assert records.encode_texts([], tokens) == [] and records.encode_texts(["", "  "], tokens) == plain(tokens, ["", "  "])


def test_groups_whose_tokens_are_no_bytes_are_encoded_word_by_word(tokens, monkeypatch):
    monkeypatch.setattr(records, "JOINED_WORDS", 3)
    monkeypatch.setattr(records, "GATHERED_WORDS", 5)
    texts = odd_texts(9) + ["one two three four five six seven"]
    for sizes in (tokens.sizes * 0, tokens.sizes + (np.arange(len(tokens.sizes)) % 7 == 0)):
        tokens.words.clear()
        other = tokens._replace(sizes=sizes)
        assert records.encode_texts(texts, other) == plain(tokens, texts)


def test_each_word_of_a_batch_is_looked_up_once(tokens, monkeypatch):
    asked = []
    numbers = records._numbers
    monkeypatch.setattr(records, "_numbers", lambda words, t: asked.append(len(words)) or numbers(words, t))
    texts = ["first " + "again and " * 500 + "last"] * 3
    assert records.encode_texts(texts, tokens) == plain(tokens, texts)
    assert asked == [3, 3] or sum(asked) < 10

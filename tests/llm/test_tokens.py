"""Encoding against the public tokenizer library, and its round trip."""

import random

import pytest
from tokenizers import Tokenizer

from locuslathe.llm import tokens
from locuslathe.llm.tokens import VOCABULARY, ByteBPE, decode_corpus, encode_corpus


@pytest.fixture(scope="module")
def public():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


ALPHABET = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", " ", "　", "a", "B", "1", "²", "ⅷ",
            "é", "中", "!", "..", "\r\n", "🎉", "​", "﻿", "ก", "\x85", "\x1c", "़", "ٱ", "'S", "<|endoftext|>"]


def test_random_texts(public):
    rng = random.Random(0)
    own = ByteBPE(VOCABULARY)
    for _ in range(60):
        texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(50)]
        assert own.encode_texts(texts) == [e.ids for e in public.encode_batch(texts, add_special_tokens=False)]


def test_long_slices(public):
    rng = random.Random(1)
    own = ByteBPE(VOCABULARY)
    texts = ["".join(rng.choice("ACGT") for _ in range(5000)), "a" * 3001, "'" * 700, " " * 900 + "x", "ab" * 1000, "中" * 400]
    assert own.encode_texts(texts) == [e.ids for e in public.encode_batch(texts, add_special_tokens=False)]


def test_corpus(spark, public, monkeypatch):
    rows = [(1, None, "a", "b"), (2, "", "a", "b"), (3, "  it's  done\n", "a", "b"), (3, "x", "a", "b"), (None, "y", "a", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, _text string")
    got = sorted(((r.doc_id or 0, r.ids) for r in encode_corpus(df).collect()), key=repr)
    assert got == sorted(((r[0] or 0, public.encode(r[1], add_special_tokens=False).ids if r[1] else []) for r in rows), key=repr)
    assert encode_corpus(df.where("doc_id = 77")).collect() == []


def test_round_trip_of_whole_table(spark, public):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    enc = encode_corpus(docs, offsets=True)
    rows = {r.doc_id: r for r in decode_corpus(enc).collect()}
    own = ByteBPE(VOCABULARY)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    want = public.encode_batch(list(texts.values()), add_special_tokens=False)
    for (i, text), w in zip(texts.items(), want):
        r = rows[i]
        assert r.ids == w.ids and r.text == text
        raw = text.encode()
        ends = [*r.byte_starts[1:], len(raw)]
        assert all(raw[a:b] == own.bytes_of[t] for a, b, t in zip(r.byte_starts, ends, r.ids))


def test_small_chunks(public, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 10)
    assert list(tokens._chunks(["a" * 30, "", "b", "c" * 9, "d"])) == [["a" * 30], ["", "b", "c" * 9], ["d"]]


def test_a_text_of_a_million_letters(public):
    rng = random.Random(4)
    text = "".join(rng.choice("ACGTN") for _ in range(1_000_000))
    assert ByteBPE(VOCABULARY).encode_texts([text]) == [public.encode(text, add_special_tokens=False).ids]

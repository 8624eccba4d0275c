"""Byte-level BPE against the public library: chunks of few characters, pre-tokens longer than a chunk, all kinds of text."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from urbanlake.llm import byte_pairs

R = random.Random(9)


@pytest.fixture(scope="module")
def library():
    with open(byte_pairs.RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    with open(byte_pairs.RANKS, "rb") as file:
        return byte_pairs.Vocabulary(file.read(), byte_pairs.PATTERN)


def text(n):
    parts = ["a", "b", "don't", "we'll", "'re", "'", "  ", "\n", " \n\n ", "1", "23", "é", "ß", "漢字", "🙂", "…", "!!", " ", " ", "the", " ", " ", "x" * 30, " " * 25, "'" * 9]
    return "".join(R.choice(parts) for _ in range(n))


def test_stitching_equals_the_library(vocabulary, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "OVERLAP", 8)
    for chunk in (5, 9, 16, 40):
        for _ in range(150):
            t = text(R.randrange(1, 120))
            machine = byte_pairs.Stitcher(vocabulary)
            for b in range(0, len(t), chunk):
                part = t[b : b + chunk + 8]
                machine.add(b, part, vocabulary.ends(part))
            assert np.frombuffer(machine.finish(), np.int32).tolist() == library.encode_ordinary(t), (chunk, t)


def test_kinds_of_spaces_letters_and_digits_are_the_librarys(vocabulary, library):
    for code in [*range(0x3100), *range(0xA000, 0xD800, 5), *range(0xE000, 0x11000), *range(0x1D400, 0x1D800, 3), *range(0x1F000, 0x1FB00)]:
        t = "a{0}b 1{0}2 .{0}! {0} {0}{0}x".format(chr(code))
        assert np.frombuffer(vocabulary.encode(vocabulary.split(t)), np.int32).tolist() == library.encode_ordinary(t), hex(code)


def test_both_ways_of_merging_are_equal(vocabulary):
    for _ in range(400):
        piece = "".join(R.choice("abcdeé漢0'") for _ in range(R.randrange(1, 60))).encode()
        assert byte_pairs._merged_words(piece, vocabulary.ranks) == byte_pairs._merged_runs(piece, vocabulary.ranks)


def test_long_pre_tokens(vocabulary, library):
    for t in ("ab" * 4000, "=" * 3000, "".join(R.choice("abcdefghijklmnop") for _ in range(5000)), "z" * 200 + "é" * 300):
        assert np.frombuffer(vocabulary.encode(vocabulary.split(t)), np.int32).tolist() == library.encode_ordinary(t)


def test_texts_of_all_lengths_and_other_columns(spark, library):
    texts = [None, "", "x", text(60), text(60), text(900), text(5000), "y" * 3000, " " * 2500 + "z", "<|endoftext|> is text"]
    texts.append(texts[5])
    rows = [(i % 7 or None, t, "kept", i) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, ids string, _row int")
    got = byte_pairs.decode_bytes(byte_pairs.encode_bytes(table, chunk=300)).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "_row", "ids", "decoded"}
    for r in got:
        t = texts[r._row] or ""
        assert r.doc_id == (r._row % 7 or None) and r.ids == library.encode_ordinary(t) and bytes(r.decoded) == t.encode()


def test_query_equals_the_library(spark, library, tmp_path):
    texts = ["Hello  world", None, "", text(40000)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in byte_pairs.op13_byte_bpe(spark, str(tmp_path)).collect():
        t = texts[r.doc_id] or ""
        ids = library.encode_ordinary(t)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_pairs.encode_bytes(empty).collect() == []

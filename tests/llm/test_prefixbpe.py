"""Byte-level BPE against the tiktoken library and against merging by rank."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from llm import prefixbpe
from llm.tokens import vocabulary

PARTS = ["a", "b", "the", "ing", "tion", " ", "  ", "\n", "\t", "\r\n", "　", "\x85", "\x1c", "​", "\x00", "é", "ß", "中", "文", "عرب", "1", "²", "½",
         "😀", "'s", "'ll", "!", "...", "<|endoftext|>", "՘", "₏", "\U00011de0"]


@pytest.fixture(scope="module")
def words():
    return prefixbpe.words_of(vocabulary(prefixbpe.VOCABULARY), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(words):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words.ranks, special_tokens={})


def random_texts(n, longest, seed=1):
    deal = random.Random(seed)
    return ["".join(deal.choices(PARTS, k=deal.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("remembered", [100_000, 2])
def test_encoder_equals_library(words, library, remembered):
    encoder = prefixbpe.Encoder(words, remembered)
    deal = random.Random(2)
    tokens = list(words.ranks)
    texts = random_texts(2000, 30) + [b"".join(deal.choices(tokens, k=5)).decode("utf8", "ignore") for _ in range(1000)]
    for text in texts + ["", "w" * 3000, " " * 3000, "ab" * 2000 + "c", "é" * 999]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text), text


def test_appends_and_edits(words, library):
    deal = random.Random(3)
    for text in random_texts(400, 25):
        kept = prefixbpe.EncodedText(words, text)
        for _ in range(4):
            a = deal.randrange(len(kept.text) + 1)
            kept.replace(a, deal.randrange(a, len(kept.text) + 1), "".join(deal.choices(PARTS, k=deal.randrange(5))))
            kept.append("".join(deal.choices(PARTS, k=deal.randrange(3))))
            assert kept.ids() == library.encode_ordinary(kept.text), kept.text


def test_every_prefix_and_an_edit_is_near(words, library):
    data = "untranslatablenessesinternationalisations" * 30
    table = prefixbpe.Prefixes(words, data.encode())
    for n in (1, 7, 100, 1000):
        assert table.ids(n) == library.encode_ordinary(data[:n])
    assert table.replace(600, 603, b"x") < 4 * words.longest
    assert table.ids() == library.encode_ordinary(data[:600] + "x" + data[603:])
    kept = prefixbpe.EncodedText(words, "one two three " * 500)
    kept.replace(3000, 3001, "?")
    assert kept.computed < 50 and kept.ids() == library.encode_ordinary(kept.text)


def test_tokens_that_no_merge_makes():
    """A token without merges is found only as a whole piece."""
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"cd": 258, b"xyz": 259, b"aa": 260, b"aaa": 261}
    words = prefixbpe.Vocabulary(ranks, r"\p{L}+|\s+")
    library = tiktoken.Encoding("small", pat_str=r"\p{L}+|\s+", mergeable_ranks=ranks, special_tokens={})
    deal = random.Random(4)
    encoder = prefixbpe.Encoder(words)
    for text in ["xyz", "xyza xyz", *("".join(deal.choices("abcdxyz ", k=9)) for _ in range(2000)), "aaaa", "aaaaa", "aaaaaaa"]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text), text


def test_query(spark, library):
    texts = ["", "two  words", "repeated", "repeated", "long text, " * 40_000, *random_texts(50, 20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, "same"), (901, "same"), (None, "no id")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, ids string")

    def digest(data):
        return hashlib.sha256(data).hexdigest()

    want = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), digest(np.array(ids, "<u4").tobytes()), digest((text or "").encode())))
    got = prefixbpe.round_trip(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
    assert prefixbpe.round_trip(docs.where("false")).count() == 0
    texts = {r["doc_id"]: r["text"] or "" for r in docs.where("doc_id is not null").collect()}
    for r in prefixbpe.decoded(prefixbpe.encoded(docs)).where("doc_id is not null").collect():
        assert bytes(r["bytes"]).decode() == texts[r["doc_id"]]
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == library.encode_ordinary(texts[r["doc_id"]])
    assert prefixbpe.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids binary")).first()["bytes"] == b""


def test_ranks_file_is_read(words):
    with open(vocabulary(prefixbpe.VOCABULARY), "rb") as lines:
        token, rank = next(lines).split()
    assert words.tokens[int(rank)] == base64.b64decode(token)

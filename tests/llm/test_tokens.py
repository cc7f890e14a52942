"""Packing and token files against the tokenizers library used plainly."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import packing, tokenfile
from llm.tokens import Encoder, vocabulary

TEXTS = [
    "", "a", " a", "a ", "  two  spaces ", "line\nbreaks\n\n\nand  more\n", "Don't they're 'quoted' it's", "tab\tand space",
    "x.y,z. A.B, end.", "ÀÉÎ é ﬁ Ω ΣΑΣ", "数字 123 4567.89", "<|endoftext|> here <|startoftext|>", "emoji 😀😀 .", "w" * 500, "a\x1cb \x85 c",
    "MiXeD Case Words", "...", ",", "end&&& 'tis, dogs' don't!? I'LL\u0301. = \u0338 x=\u0338 (a) 12%.5%. ΣΑΣ. ΣΑΣ ½. Ⅷ,", "a\xa0b\u2003c\u3000", "word ." * 50, "\r\nwindows\r\n",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("remembered", [400_000, 8, 40])
def test_encoder_equals_library(name, remembered):
    whole = Tokenizer.from_file(vocabulary(name))
    whole.encode_special_tokens = True
    encoder = Encoder(vocabulary(name), remembered)
    for text in TEXTS * 2:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(1000, None), (1001, "long words " * 9000), (1002, "b"), (1002, "b"), (None, "no id")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash"))


def expected(docs, name, end):
    plain = Tokenizer.from_file(vocabulary(name))
    plain.encode_special_tokens = True
    return [(r["doc_id"], np.array([*plain.encode(r["text"] or "", add_special_tokens=False).ids, end], "<u4")) for r in docs.collect()]


def test_packing(spark, docs):
    got = packing.packed(docs).collect()
    want = []
    for doc_id, ids in expected(docs, "word_bpe_49k.json", 1):
        want += [(doc_id, i, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for i, a in enumerate(range(0, len(ids), 4096))]
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(sequences) == -(-sum(r["length"] for r in got) // 4096)
    assert packing.packed(docs.where("false")).count() == 0


def test_bounded_best_fit():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(s) for s in (6, 7, 3, 2, 2, 9, 8, 1)] == [(0, 0), (1, 0), (1, 7), (0, 6), (0, 8), (2, 0), (3, 0), (2, 9)]
    rng = np.random.default_rng(0)
    bins, used = packing.OpenBins(100, 8), {}
    for s in rng.integers(1, 101, 3000).tolist():
        b, at = bins.put(s)
        assert used.get(b, 0) == at
        used[b] = at + s
        assert used[b] <= 100 and bins.open <= 8
    assert sum(used.values()) / (100 * len(used)) > 0.85


def test_token_files(spark, docs):
    got = sorted(tokenfile.round_trip(docs).collect(), key=lambda r: r["start"])
    want = expected(docs, "byte_bpe_50k.json", 2)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(d), len(i), zlib.crc32(i.tobytes())) for d, i in want)
    assert tokenfile.round_trip(docs.where("false")).count() == 0

"""Lexical search against plain counting."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm import slicesearch

PATTERN = re.compile(slicesearch.PATTERN)
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHAPE = "doc_id long, text string, item_id long, score string"


def terms_of(text):
    return PATTERN.findall((text or "").translate(UPPER))


def brute_force(docs, items, top=10):
    held = [(d, Counter(terms_of(t))) for d, t, *_ in docs if terms_of(t)]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    found = []
    for item, terms in asked.items():
        scores = []
        for doc, counts in held:
            m = 100 - 90 + (90 * counts.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m)) for t in terms if t in counts)
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found += [(item, i, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(found, key=str)


def same(spark, docs, items):
    frame = spark.createDataFrame([(*d, 7, "clash") for d in docs], SHAPE)
    got = slicesearch.search(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs, items)


def dealt(seed, n, words=400):
    deal = random.Random(seed)
    vocabulary = ["".join(deal.choices("abcdeéß文", k=deal.randrange(1, 6))) for _ in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(deal.choices(vocabulary, weights, k=deal.choice([0, 3, 30, 300, 2000])))) for i in range(n)]


def test_random_texts(spark):
    docs = dealt(1, 400)
    items = [(i, " ".join(docs[i * 3][1].split()[:40])) for i in range(40)]
    same(spark, docs, items)


def test_copies_ties_and_odd_rows(spark):
    docs = [(i, "the same passage in many documents") for i in range(300, 0, -1)] + dealt(2, 50)
    docs += [(None, "the same passage in many documents"), (None, None), (901, None), (902, ""), (903, " -,. "), (5, "the same passage in many documents")]
    docs += [(904, "ÀB Àb àb ÀB's x_y-z\x00q 中文　中文"), (905, "word " * 100_000 + "passage")]
    items = [(1, "THE same PASSAGE"), (2, "àb Àb"), (3, None), (4, ""), (5, "absent"), (None, "q x y"), (6, "passage"), (6, "word"), (7, "中文　中文")]
    same(spark, docs, items)


def test_groups_of_items_and_handed_on_counts(spark, monkeypatch):
    monkeypatch.setattr(slicesearch, "QUERY_TERMS", 20)
    monkeypatch.setattr(slicesearch, "FREQUENCIES", 10)
    monkeypatch.setattr(slicesearch, "BLOCK_BITS", 1 << 14)
    docs = dealt(3, 150, 100)
    same(spark, docs, [(i, " ".join(docs[i][1].split()[:9])) for i in range(12)])


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.where("false"), items), (docs, items.where("false")), (docs.where("false"), items.where("false"))):
        assert slicesearch.search(d, i).count() == 0


@pytest.mark.parametrize("words", [3, 200])
def test_bounds_never_lie_below_scores_and_are_mostly_tight(words):
    docs = [(d, t) for d, t in dealt(4, 300, words) if t]
    block = {}
    for d, t in docs:
        counts = Counter(slicesearch.terms_of(t.encode()))
        found = slicesearch.entries(slicesearch.hashed(counts), np.fromiter(counts.values(), np.int64))
        width = slicesearch.BITS << max(int(len(found) - 1).bit_length(), 6)
        block.setdefault(width, slicesearch.Block(width)).add(d, 0, counts.total(), found)
    rows = [(0, t, 100 + i) for i, t in enumerate(sorted({t for _, x in docs for t in slicesearch.terms_of(x.encode())})[:50])]
    items = slicesearch.Items(rows, len(docs), sum(len(t.split()) for _, t in docs))
    texts, tight = dict(docs), 0
    for b in block.values():
        row = b.row()
        for item, bounds in items.bounds(row["width"], np.array(row["lengths"]), row["slices"]):
            for doc, bound in zip(row["docs"], bounds):
                counts = Counter(slicesearch.terms_of(texts[doc].encode()))
                exact = items.score(item, counts, counts.total())
                assert bound >= exact
                tight += bound <= exact * 1.05 + 1
    assert tight > 0.9 * len(docs)

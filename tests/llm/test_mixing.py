"""Mixing against plain Python."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from llm import mixing

SCHEMA = "doc_id long, text string, source string"


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, Fraction(sum(sizes.values())), list(names)
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not above:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in above:
            target[s] = Fraction(3 * sizes[s])
            left -= target[s]
            open_.remove(s)
    return {s: float(t) for s, t in target.items()}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["a", "bb", "c\n", "\td"], k=rng.randint(0, 900))), rng.choice(["x", "y", "z", "É", None] + ["hot"] * 4)) for i in range(300)]
    rows += [(900, None, "x"), (901, "", None), (902, "only words here", "tiny"), (903, "a b c", None), (903, "a b c", None)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("target", F.lit("clash"))


def test_mix(spark, docs):
    got = mixing.mix(docs, block=32).collect()
    rows = docs.collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r["doc_id"], size(r["text"])) for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += size(r["text"])
    expected = plain_targets(sizes)
    source = {r["doc_id"]: r["source"] for r in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(expected[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s, t in expected.items():
        assert abs(taken[s] - t) <= 0.02 * t + 64
    again = mixing.mix(docs.repartition(7), block=32).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_documents_hold_the_words_taken(spark, docs):
    plain = docs.drop("target")
    made = defaultdict(int)
    for r in mixing.mixed_documents(plain, block=32).collect():
        made[r["doc_id"]] += len((r["text"] or "").split())
    taken = defaultdict(int)
    for r in mixing.mix(plain, block=32).collect():
        taken[r["doc_id"]] += r["taken"]
    assert {k: v for k, v in made.items() if v} == {k: v for k, v in taken.items() if v}
    texts = {r["doc_id"]: r["text"] for r in plain.collect()}
    once = [r for r in mixing.mixed_documents(plain, block=32).collect() if r["doc_id"] < 300]
    assert all(" ".join(r["text"].split()) in " ".join(texts[r["doc_id"]].split()) for r in once if r["text"] == texts[r["doc_id"]])


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
def test_permutations(spark, size):
    df = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size), F.lit("s"), F.lit(0)).alias("p"))
    assert sorted(r["p"] for r in df.collect()) == list(range(size))


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 1, "b": 1000, "c": 5}, {"a": 0, "b": 3}, {"a": 2, "b": 2, "c": 900, None: 4, "d": 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_empty(spark, docs):
    assert mixing.mix(docs.where("false")).count() == 0
    assert mixing.mix(docs.where("doc_id >= 900 AND doc_id < 902")).select("taken").distinct().collect() == [(0,)]

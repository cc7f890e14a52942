"""Fingerprints and their groups against plain Python."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from llm import simhash
from llm.components import connected


def plain(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n ", "One", "one two three", "a b c d", "A b C d e f", "é É ß a b\tc\nd", "x " * 3000, "a b c d e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def brute_groups(fps, radius=4):
    label = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if bin(fps[i] ^ fps[j]).count("1") <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@pytest.mark.parametrize("limit", [4_000_000, 3_000])
def test_groups_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "VARIANTS_IN_MEMORY", limit)
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(25)] + [0, (1 << 64) - 1]
    values = list(base)
    for b in base:
        for _ in range(4):
            flips = rng.sample(range(64), rng.randint(1, 6))
            values.append(b ^ sum(1 << f for f in flips))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in set(signed)], "fp long"))
    groups = {r["node"]: r["component"] for r in connected(links).collect()}
    fps = {s: s & ((1 << 64) - 1) for s in set(signed)}
    expected = brute_groups(fps)
    assert {s: groups.get(s, s) for s in fps} == expected


def test_documents(spark):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(5, text), (3, text), (9, text + " extra"), (7, None), (8, " "), (None, text), (4, "something else entirely here now"), (4, "something else entirely here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit(1))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5]["component_id"] == by_id[3]["component_id"] == 3 == by_id[None]["component_id"]
    assert by_id[7]["fingerprint"] == "0" * 16 and by_id[8]["component_id"] == 7
    assert by_id[4]["fingerprint"] == f"{plain(rows[-1][1]):016x}"
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 3, 4, 7] + ([9] if by_id[9]["component_id"] == 9 else [])
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_one_text_of_each_group_stays_whatever_the_order(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(80)) for w in "ab")
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, b, "x"), (2, b, "y"), (5, None, "x"), (5, "", "x"), (None, a, "x")]
    for given in (rows, rows[::-1]):
        docs = spark.createDataFrame(given, "doc_id long, text string, component string").repartition(3)
        got = sorted(map(str, map(tuple, simhash.keep_one(docs).collect())))
        assert [r for r in got if "None, 'a0" not in r] in ([f"(1, '{a}', 'x')", f"(2, '{b}', '{c}')", f"(5, {e}, 'x')"] for c in "xy" for e in ("None", "''"))
        assert len(got) == 4
        first = got if given is rows else first
    assert got == first


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}

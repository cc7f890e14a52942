"""Near duplicates and neighbours of vectors against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import forest, nndescent

SCHEMA = "vec_id long, embedding array<float>"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((150, 16))
    data = list(base) + [base[0]] * 30 + [base[1] + 0.1 * rng.standard_normal(16) for _ in range(60)]
    data += [base[2] + 0.35 * rng.standard_normal(16) for _ in range(40)] + [3 * base[5]]
    made = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(data)]
    made += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [math.nan] + [1.0] * 15), (1004, [math.inf] + [1.0] * 15), (1005, [None] + [1.0] * 15), (1006, [1.0] * 5), (None, [1.0] * 16)]
    random.Random(0).shuffle(made)
    return spark.createDataFrame(made, SCHEMA).withColumn("n_links", F.lit("clash"))


def usable(rows):
    found = {}
    for r in rows.collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            found[r["vec_id"]] = np.array(v, float)
    return found


@pytest.mark.parametrize("k", [16, 4])
def test_near_duplicates(spark, rows, k):
    good = usable(rows)
    ids = sorted(good)
    x = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    label = np.array(ids)
    for _ in ids:
        label = np.array([min(label[i], label[linked[i]].min(initial=1 << 60)) for i in range(len(ids))])
    want = {i: (int(n), int(c), bool(i == c)) for i, n, c in zip(ids, linked.sum(1), label)}
    got = nndescent.near_duplicates(rows, k=k).collect()
    assert len(got) == rows.count()
    assert {r["vec_id"]: tuple(r)[1:] for r in got if r["vec_id"] in want} == want
    assert {tuple(r) for r in got if r["vec_id"] not in want} == {(i, 0, i, True) for i in range(1000, 1007)} | {(None, 0, None, None)}


def brute(x):
    """(links, smallest reachable row) of every row by brute force."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    while True:
        least = np.minimum(label, np.where(linked, label, len(x)).min(axis=1))
        if (least == label).all():
            return [(int(n), int(c)) for n, c in zip(linked.sum(1), label)]
        label = least


def links(spark, x, **options):
    made = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], SCHEMA)
    return [(r["n_links"], r["component_id"]) for r in sorted(nndescent.near_duplicates(made, **options).collect(), key=lambda r: r["vec_id"])]


def tight(rng, centre, n, spread):
    return centre + spread * rng.standard_normal((n, len(centre))) / math.sqrt(len(centre))


def test_links_between_saturated_components(spark, monkeypatch):
    rng = np.random.default_rng(8)
    a, b, c = np.linalg.qr(rng.standard_normal((32, 3)))[0].T
    close = 0.96 * a + math.sqrt(1 - 0.96**2) * b
    x = np.float32(np.r_[tight(rng, a, 60, 0.03), tight(rng, close, 40, 0.03), tight(rng, c, 30, 0.03), tight(rng, 0.93 * c + 0.367 * b, 30, 0.03)])
    want = brute(np.float64(x))
    assert want[0][0] >= 99 and want[0][1] == want[60][1] and want[100][1] != want[130][1]
    assert links(spark, x) == want
    monkeypatch.setattr(nndescent, "BLOCK", 16)
    monkeypatch.setattr(nndescent, "CENTRES", 2)
    assert links(spark, x) == want


def test_pairs_missed_beside_a_hot_group(spark, monkeypatch):
    rng = np.random.default_rng(9)
    hot, pairs = rng.standard_normal(24), rng.standard_normal((60, 24))
    x = np.float32(np.r_[hot + 0.02 * rng.standard_normal((120, 24)), pairs, pairs + 0.02 * rng.standard_normal((60, 24))])
    want = brute(np.float64(x))
    assert [n for n, _ in want[120:]] == [1] * 120
    # A graph that has nothing but the hot group, whatever the fit.
    graph = nndescent.neighbour_graph
    monkeypatch.setattr(nndescent, "neighbour_graph", lambda points, *a: graph(points.where("id < 120"), *a))
    monkeypatch.setattr(nndescent, "REFITS", 1)
    monkeypatch.setattr(nndescent, "CENTRES", 50)
    assert links(spark, x, trees=2, rounds=1) == want


def test_audit_counts_nodes(spark):
    x = np.r_[np.tile(np.eye(4)[0], (50, 1)) + 0.001 * np.arange(50)[:, None], np.repeat(np.eye(4)[1:3], 2, axis=0) + 0.001 * np.eye(4)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    others = points.select("id", F.when(F.col("id") < 50, 49).when(F.col("id") < 52, 1).otherwise(0).alias("others"))
    assert nndescent.audit(others, points, 0.95, 256, 16) == 0.5


def test_nearest_neighbours(spark, rows):
    good = usable(rows)
    got = forest.search(rows, rows.where("vec_id % 20 = 0"), nearest=20)
    hits = total = 0
    for q in (i for i in good if i % 20 == 0):
        scores = {i: float(good[q] @ v) for i, v in good.items() if i != q}
        best = sorted(scores, key=lambda i: (-round(scores[i], 9), i))[:20]
        mine = sorted((r for r in got.where(f"query_id = {q}").collect()), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert all(abs(r["score"] - scores[r["vec_id"]]) < 1e-9 for r in mine)
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        hits, total = hits + len({r["vec_id"] for r in mine} & set(best)), total + 20
    assert hits / total >= 0.9
    assert forest.recall(got, rows) >= 0.9
    few = rows.where("vec_id IN (1, 20, 40, 1000)")
    assert forest.search(few, few.where("vec_id % 20 = 0")).count() == 4


def test_empty(spark, rows):
    none = rows.where("false")
    assert nndescent.near_duplicates(none).count() == 0
    assert forest.search(none, none).count() == 0

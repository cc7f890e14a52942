"""Embedding near-dedup on a neighbour graph refined by NN-descent.

Equal vectors are one node with a count.  The first graph comes from a few random
projection trees: nodes sorted by the signs of projections, compared within short runs.
Each round joins every node's neighbours (and the nodes that have it as a neighbour) with
each other and keeps the best of each list.  Lists hold neighbours that could lead to a
link: two nodes that link with a third are never further apart than twice the link's
angle.

A list that is full of links is saturated: there may be more.  It is enlarged to its whole
component.  Members of the component near its centre (within half the link's angle) are
linked with each other for certain, so they are counted, not listed; the other members are
compared with all of the component in blocks.  Links between two components are lost if
both ends are saturated: cells of such components whose centres and radii allow a link are
compared, and components that link become one.  Recall is audited on a sample by brute
force, node by node; below the wanted share, more trees and rounds follow, and after the
last of them all nodes are compared with each other in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.components import connected
from llm.forest import usable, usual_width
from llm.shared import vectors, written

COSINE = 0.95
NEIGHBOURS = 16
TREES = 12
RUN = 64  # nodes compared with each other in a tree's order
ROUNDS = 4
AUDITED = 256  # nodes at least, or the root of their number, from each of three strata
WANTED = 0.999
REFITS = 3
SEED = 5
BLOCK = 1024
CENTRES = 2048  # cells (or nodes, by brute force) compared at once with as many others
EDGE = "a long, b long, sim double"


def _dot(x: str, y: str) -> Column:
    products = F.zip_with(x, y, lambda p, q: p * q)
    return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)


def _edges(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sim)], names=["a", "b", "sim"])


def _best(ids: np.ndarray, points: np.ndarray, k: int, floor: float) -> Iterator[pa.RecordBatch]:
    """Each point's k nearest of the others, if not below the floor."""
    sims = points @ points.T
    np.fill_diagonal(sims, -2)
    if len(ids) > k + 1:
        least = np.partition(sims, len(ids) - k, axis=1)[:, len(ids) - k]
        sims[sims < least[:, None]] = -2
    i, j = np.nonzero(sims >= floor)
    if len(i):
        yield _edges(ids[i], ids[j], sims[i, j])


def nodes(rows: DataFrame) -> DataFrame:
    """(k1, k2, id, n, vec): different usable vectors, with unit length; id is the smallest vec_id."""
    width = usual_width(rows)
    fits = rows.where(usable(F.col("embedding")) & (F.size("embedding") == width) & F.col("vec_id").isNotNull())
    values = F.transform("embedding", lambda x: x.cast("double"))
    keyed = fits.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("v")).select(
        "vec_id", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(7), "v").alias("k2")
    )
    grouped = keyed.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"), F.min_by("v", "vec_id").alias("v")
    )
    largest = F.array_max(F.transform("v", F.abs))  # first, so that no square overflows or vanishes
    scaled = grouped.withColumn("v", F.transform("v", lambda x: x / largest))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    # A vec_id may repeat with different vectors; then nodes need ids of their own.
    repeated = W.partitionBy("id")
    return scaled.select("k1", "k2", "id", "n", F.transform("v", lambda x: x / length).alias("vec"), F.count("*").over(repeated).alias("same"))


def _seeded(points: DataFrame, trees: int, seed: int, k: int, floor: float) -> DataFrame:
    """Edges from runs of neighbours in random projection trees."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, values = vectors(batch.column(1))
            if not len(values):
                continue
            rng = np.random.default_rng(seed)
            planes = rng.standard_normal((values.shape[1], trees * 63))
            weights = 1 << np.arange(62, -1, -1, dtype=np.int64)
            vec = pa.ListArray.from_arrays(
                pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.astype(np.float32).ravel())
            )
            for t in range(trees):
                code = (values @ planes[:, t * 63 : t * 63 + 63] > 0) @ weights
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), t, np.int32)), pa.array(code), batch.column(0), vec],
                    names=["tree", "code", "id", "vec"],
                )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, ids = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            _, values = vectors(batch.column(3))
            for at in range(0, len(ids), RUN):
                part = slice(at, at + RUN)
                for t in np.unique(tree[part]):
                    here = tree[part] == t
                    yield from _best(ids[part][here], values[part][here], k, floor)

    coded = points.select("id", "vec").mapInArrow(codes, "tree int, code long, id long, vec array<float>")
    return coded.repartitionByRange("tree", "code", "id").sortWithinPartitions("tree", "code", "id").mapInArrow(runs, EDGE)


def _kept(edges: DataFrame, k: int) -> DataFrame:
    """The k best edges of every node."""
    best = W.partitionBy("a").orderBy(F.desc("sim"), "b")
    once = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")


def _joined(edges: DataFrame, points: DataFrame, k: int, floor: float) -> DataFrame:
    """One round: neighbours of the same node compared with each other."""
    near = W.partitionBy("a").orderBy(F.desc("sim"), "b")
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim")
    back = back.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k).drop("rank")
    own = edges.select("a", F.col("a").alias("b")).distinct()
    members = edges.select("a", "b").unionByName(back.select("a", "b")).unionByName(own).distinct()
    with_vec = members.join(points.select(F.col("id").alias("b"), F.col("vec").cast("array<float>").alias("vec")), "b")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids: list[np.ndarray] = []
        held: list[np.ndarray] = []
        pivot = None
        for batch in batches:
            pivots, ids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            _, values = vectors(batch.column(2))
            cuts = np.r_[0, np.flatnonzero(np.diff(pivots)) + 1, len(ids)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                if pivots[i] != pivot and held:
                    yield from _best(np.concatenate(held_ids), np.concatenate(held), k, floor)
                    held_ids, held = [], []
                pivot = pivots[i]
                held_ids.append(ids[i:j])
                held.append(values[i:j])
        if held:
            yield from _best(np.concatenate(held_ids), np.concatenate(held), k, floor)

    dealt = with_vec.select("a", "b", "vec").repartition("a").sortWithinPartitions("a", "b")
    return dealt.mapInArrow(local, EDGE)


def neighbour_graph(points: DataFrame, k: int, floor: float, trees: int, rounds: int, seed: int, start: DataFrame | None = None) -> DataFrame:
    """(a, b, sim): every node's neighbour list after NN-descent."""
    fresh = _seeded(points, trees, seed, k, floor)
    graph = written(_kept(fresh if start is None else fresh.unionByName(start), k), "graph")
    before = None
    for _ in range(rounds):
        graph = written(_kept(graph.unionByName(_joined(graph, points, k, floor)), k), "graph")
        now = graph.agg(F.count("*"), F.round(F.sum("sim"), 6)).first()
        if now == before:
            break
        before = now
    return graph


def _links(graph: DataFrame, points: DataFrame, cosine: float) -> DataFrame:
    """(a, b), a < b: edges whose exact cosine reaches the threshold."""
    close = graph.where(F.col("sim") >= cosine - 1e-5).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = points.select(F.col("id").alias("a"), F.col("vec").alias("x"))
    right = points.select(F.col("id").alias("b"), F.col("vec").alias("y"))
    return close.join(left, "a").join(right, "b").where(_dot("x", "y") >= cosine).select("a", "b")


def _blocked(rows: DataFrame, size: int, columns: list[str]) -> DataFrame:
    """Every two blocks of rows (``i``, ``j``; i <= j) meet once; ``first``: whether a row is of block i."""
    blocks = max(1, math.ceil(rows.count() / size))
    own = F.pmod(F.xxhash64(F.lit(3), columns[0]), F.lit(blocks)).cast("int")
    met = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return met.select(
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("first"), *columns
    )


def _cells(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cell, component, id, vec), and (cell, component, vec, angle): cells of some BLOCK members of a component at most.

    Their centres, and the largest angle of a member to it.  Cells are parted by the signs
    of projections, so that a component that is no ball has narrow ones, then by hash.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.log2(F.greatest(F.count("*") / BLOCK, F.lit(1.0)))).cast("int").alias("bits"))

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, values = vectors(batch.column(3))
            if len(values):
                planes = np.random.default_rng(SEED).standard_normal((values.shape[1], 30))
                code = ((values @ planes > 0) @ (1 << np.arange(30))) & ((1 << np.minimum(np.asarray(batch.column(2)), 30)) - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(code.astype(np.int64)), batch.column(3)], names=["component", "id", "code", "vec"]
                )

    coded = written(
        members.join(sizes, "component").select("component", "id", "bits", "vec")
        .mapInArrow(signs, "component long, id long, code long, vec array<double>"),
        "coded",
    )
    parts = coded.groupBy("component", "code").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    dealt = written(
        coded.join(parts, ["component", "code"]).withColumn("part", F.pmod(F.xxhash64(F.lit(4), "id"), F.col("parts"))).drop("parts"), "dealt"
    )
    key = ["component", "code", "part"]
    named = dealt.groupBy(*key).agg(F.min("id").alias("cell"))
    placed = written(dealt.join(named, key).select("cell", "component", "id", "vec"), "cells")
    sums = placed.select("cell", F.posexplode("vec").alias("at", "x")).groupBy("cell", "at").agg(F.sum("x").alias("x"))
    centre = sums.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("c")).select(
        "cell", F.transform("c", lambda p: p["x"]).alias("c")
    )
    length = F.sqrt(F.aggregate("c", F.lit(0.0), lambda s, x: s + x * x))
    centre = written(centre.withColumn("c", F.transform("c", lambda x: x / F.greatest(length, F.lit(1e-300)))), "centre")
    # A centre of length zero covers its members with half a turn.
    cosine = F.when(F.exists("c", lambda x: x != 0), _dot("vec", "c")).otherwise(-1.0)
    shapes = placed.join(centre, "cell").groupBy("cell", "component").agg(
        F.first("c").alias("vec"), (F.acos(F.greatest(F.least(F.min(cosine), F.lit(1.0)), F.lit(-1.0))) + 1e-6).alias("angle")
    )
    return placed, written(shapes, "shapes")


def _near_cells(shapes: DataFrame, cosine: float) -> DataFrame:
    """(a, b, ca, cb, gap): cells of different components whose members may link; gap: the angle between them."""
    theta = math.acos(cosine) + 1e-6

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        first, same = np.asarray(table.column("first")), table.column("i")[0].as_py() == table.column("j")[0].as_py()
        centres = np.asarray(table.column("vec").combine_chunks().flatten()).reshape(table.num_rows, -1)
        cell, component, angle = (np.asarray(table.column(c)) for c in ("cell", "component", "angle"))
        a = np.flatnonzero(first)
        b = a if same else np.flatnonzero(~first)
        gap = np.arccos(np.clip(centres[a] @ centres[b].T, -1, 1)) - angle[a][:, None] - angle[b][None, :]
        near = (gap <= theta) & (component[a][:, None] != component[b][None, :])
        if same:
            near &= cell[a][:, None] < cell[b][None, :]
        x, y = np.nonzero(near)
        return pa.table({"a": cell[a[x]], "b": cell[b[y]], "ca": component[a[x]], "cb": component[b[y]], "gap": gap[x, y]})

    met = _blocked(shapes, CENTRES, ["cell", "component", "vec", "angle"])
    return met.groupBy("i", "j").applyInArrow(compare, "a long, b long, ca long, cb long, gap double")


def _one_link(pairs: DataFrame, placed: DataFrame, cosine: float) -> DataFrame:
    """(a, b): one link between the members of every two cells that have any."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, first = np.asarray(table.column("id")), np.asarray(table.column("first"))
        values = np.asarray(table.column("vec").combine_chunks().flatten()).reshape(table.num_rows, -1)
        a, b = np.flatnonzero(first), np.flatnonzero(~first)
        if not len(a) or not len(b):
            return pa.table({"a": ids[:0], "b": ids[:0]})
        sims = values[a] @ values[b].T
        x, y = np.unravel_index(sims.argmax(), sims.shape)
        found = slice(0, int(sims[x, y] >= cosine))
        return pa.table({"a": ids[a[[x]]][found], "b": ids[b[[y]]][found]})

    sides = pairs.select("a", "b", F.col("a").alias("cell"), F.lit(True).alias("first")).unionByName(
        pairs.select("a", "b", F.col("b").alias("cell"), F.lit(False).alias("first"))
    )
    met = sides.join(placed, "cell").select("a", "b", "first", "id", "vec")
    return met.groupBy("a", "b").applyInArrow(compare, "a long, b long")


def _bridges(groups: DataFrame, saturated: DataFrame, points: DataFrame, cosine: float) -> DataFrame | None:
    """(a, b): links that make one component of saturated components that link; None if there are none.

    Cells that are nearest for their components are compared first; of the others, those of
    components that are still apart.
    """
    full = groups.join(saturated, groups["node"] == saturated["a"], "left_semi").select("component").distinct()
    if full.limit(2).count() < 2:
        return None
    members = groups.join(full, "component", "left_semi").join(points, groups["node"] == points["id"]).select("component", "id", "vec")
    placed, shapes = _cells(members)
    pairs = written(
        _near_cells(shapes, cosine).withColumn("low", F.least("ca", "cb")).withColumn("high", F.greatest("ca", "cb")), "near_cells"
    )
    best = written(
        pairs.groupBy("low", "high").agg(F.min_by(F.struct("a", "b"), F.struct("gap", "a", "b")).alias("p")).select("p.a", "p.b"), "best"
    )
    found = written(_one_link(best, placed, cosine), "bridges")
    owner = placed.select("id", "component")
    joined = found.join(owner.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a").join(
        owner.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b"
    )
    label = written(connected(joined.select(F.col("ca").alias("a"), F.col("cb").alias("b"))), "labels")
    left, right = (label.select(F.col("node").alias(c), F.col("component").alias(n)) for c, n in (("ca", "la"), ("cb", "lb")))
    rest = (
        pairs.join(best, ["a", "b"], "left_anti").join(left, "ca", "left").join(right, "cb", "left")
        .where(F.coalesce("la", "ca") != F.coalesce("lb", "cb")).select("a", "b")
    )
    return found.unionByName(written(_one_link(rest, placed, cosine), "bridges"))


def audit(counts: DataFrame, points: DataFrame, cosine: float, sample: int, k: int, seed: int = 0) -> float:
    """Mean recall of the nodes that have links (column ``others``: different linked vectors found).

    A sample of nodes without found links, with fewer than k, and with more is compared with
    all by brute force, other nodes for each seed.  The first two strata count by their
    sizes, so that no large group hides what small ones miss; the smaller of their recall
    and the last stratum's is the result.
    """
    stratum = F.when(F.col("others") == 0, 0).when(F.col("others") < k, 1).otherwise(2)
    placed = counts.withColumn("stratum", stratum)
    sizes = {r["stratum"]: r["count"] for r in placed.groupBy("stratum").count().collect()}
    most = max(sample, math.isqrt(sum(sizes.values())))
    chosen = []
    for s in sorted(sizes):
        some = placed.where(F.col("stratum") == s).orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(most)
        chosen += points.join(some, "id").select("vec", "others", "stratum").collect()
    if not chosen:
        return 1.0
    values = np.array([r["vec"] for r in chosen])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(values), np.int64)
        for batch in batches:
            _, here = vectors(batch.column(0))
            for at in range(0, len(here), BLOCK):
                total += (values @ here[at : at + BLOCK].T >= cosine).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "n"])

    true = {r["i"]: r["n"] - 1 for r in points.select("vec").mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()}
    drawn = {s: sum(r["stratum"] == s for r in chosen) for s in sizes}
    found, linked = np.zeros(2), np.zeros(2)
    for i, r in enumerate(chosen):
        if true[i] > 0:
            weight, large = sizes[r["stratum"]] / drawn[r["stratum"]], int(r["stratum"] == 2)
            found[large] += weight * min(r["others"], true[i]) / true[i]
            linked[large] += weight
    return float(min((f / n for f, n in zip(found, linked) if n), default=1.0))


def exact_graph(points: DataFrame, k: int, floor: float) -> DataFrame:
    """(a, b, sim): every node's k nearest if not below the floor, all nodes compared in blocks."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        first, same = np.asarray(table.column("first")), table.column("i")[0].as_py() == table.column("j")[0].as_py()
        ids = np.asarray(table.column("id"))
        values = np.asarray(table.column("vec").combine_chunks().flatten()).reshape(table.num_rows, -1)
        if same:
            parts = list(_best(ids, values, k, floor))
        else:
            a, b = np.flatnonzero(first), np.flatnonzero(~first)
            parts = []
            for x, y in ((a, b), (b, a)) if len(a) and len(b) else ():
                sims = values[x] @ values[y].T
                if len(y) > k:
                    sims[sims < np.partition(sims, len(y) - k, axis=1)[:, len(y) - k, None]] = -2
                p, q = np.nonzero(sims >= floor)
                parts.append(_edges(ids[x[p]], ids[y[q]], sims[p, q]))
        return pa.Table.from_batches(parts or [_edges(ids[:0], ids[:0], np.zeros(0))])

    met = _blocked(points, CENTRES, ["id", "vec"])
    return _kept(met.groupBy("i", "j").applyInArrow(compare, EDGE), k)


def _counts(links: DataFrame, points: DataFrame, groups: DataFrame, saturated: DataFrame, cosine: float) -> DataFrame:
    """(id, linked: rows linked through other vectors, others: those vectors)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = points.select(F.col("id").alias("b"), "n")
    listed = both.join(weights, "b").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("linked"), F.count("*").alias("others"))
    dense = groups.join(saturated, groups["node"] == saturated["a"], "left_semi").select("component").distinct()
    members = written(
        groups.join(dense, "component", "left_semi").join(points, groups["node"] == points["id"]).select("component", "id", "n", "vec"),
        "dense",
    )
    exact = _dense_counts(members, cosine)
    return (
        listed.join(exact.select("id"), "id", "left_anti").unionByName(exact)
    )


def _dense_counts(members: DataFrame, cosine: float) -> DataFrame:
    """Exact counts within each component."""
    half = math.acos(cosine) / 2 - 1e-6
    sums = members.select("component", F.posexplode("vec").alias("at", "x")).groupBy("component", "at").agg(F.sum("x").alias("x"))
    centre = sums.groupBy("component").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("c")).select(
        "component", F.transform("c", lambda p: p["x"]).alias("c")
    )
    length = F.sqrt(F.aggregate("c", F.lit(0.0), lambda s, x: s + x * x))
    centre = written(centre.withColumn("c", F.transform("c", lambda x: x / F.greatest(length, F.lit(1e-300)))), "centre")
    placed = written(
        members.join(centre, "component").withColumn("core", _dot("vec", "c") >= math.cos(half)).drop("c"), "placed"
    )
    shape = written(
        placed.groupBy("component").agg(
            F.sum(F.when(F.col("core"), F.col("n")).otherwise(0)).alias("core_n"),
            F.sum(F.col("core").cast("long")).alias("core_k"),
            F.ceil(F.sum((~F.col("core")).cast("long")) / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"),
        ),
        "shape",
    )
    sized = placed.join(shape.where("blocks > 0").select("component", "blocks", "parts"), "component")
    own_part, own_block = (F.pmod(F.xxhash64(F.lit(s), "id"), F.col(c)).cast("int") for s, c in ((1, "parts"), (2, "blocks")))
    # Every pair of a block of outer members and a part of all members meets once.
    columns = ["component", "block", "part", "outer", "id", "n", "core", "vec"]
    outer = sized.where("NOT core").select(
        "component", own_block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("outer"), "id", "n", "core", "vec"
    )
    everyone = sized.select(
        "component", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), own_part.alias("part"), F.lit(False).alias("outer"), "id", "n", "core", "vec"
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_outer = np.asarray(table.column("outer"))
        _, values = vectors(table.column("vec").combine_chunks())
        ids, n, core = (np.asarray(table.column(c)) for c in ("id", "n", "core"))
        a, b = np.flatnonzero(is_outer), np.flatnonzero(~is_outer)
        near = (values[a] @ values[b].T >= cosine) & (ids[a][:, None] != ids[b][None, :])
        reached = near[:, core[b]].any(axis=0)
        inner = b[core[b]][reached]
        return pa.table({
            "id": np.r_[ids[a], ids[inner]],
            "linked": np.r_[near @ n[b], n[a] @ near[:, core[b]][:, reached]].astype(np.int64),
            "others": np.r_[near.sum(axis=1), near[:, core[b]][:, reached].sum(axis=0)].astype(np.int64),
        })

    extra = (
        outer.unionByName(everyone).select(*columns).groupBy("component", "block", "part")
        .applyInArrow(compare, "id long, linked long, others long")
        .groupBy("id").agg(F.sum("linked").alias("linked"), F.sum("others").alias("others"))
    )
    certain = placed.join(shape, "component").select(
        "id",
        F.when(F.col("core"), F.col("core_n") - F.col("n")).otherwise(0).alias("linked"),
        F.when(F.col("core"), F.col("core_k") - 1).otherwise(0).alias("others"),
    )
    return certain.unionByName(extra).groupBy("id").agg(F.sum("linked").alias("linked"), F.sum("others").alias("others"))


def near_duplicates(
    rows: DataFrame, cosine: float = COSINE, k: int = NEIGHBOURS, trees: int = TREES, rounds: int = ROUNDS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``rows`` (vec_id, embedding).

    Rows link at a cosine of ``cosine`` or more, in double precision.  n_links counts other
    rows; component_id is the smallest vec_id reachable; kept marks the rows that bear it.
    Vectors that are null, zero, hold null or non-finite components, or have an unusual
    number of them link with nothing, nor do rows without a vec_id (their component_id and
    kept are null).  Rows that repeat a vec_id count as rows of their own.
    """
    every = written(nodes(rows), "nodes")
    points = written(
        every.withColumn("name", F.col("id")).withColumn(
            "id", F.when(F.col("same") == 1, F.col("id")).otherwise(F.xxhash64("k1", "k2", "id"))
        ).drop("same"),
        "points",
    )
    floor = math.cos(2 * math.acos(cosine)) - 1e-3
    graph = None
    for fit in range(REFITS + 1):
        if fit < REFITS:
            graph = neighbour_graph(points, k, floor, trees, rounds, SEED + fit, graph)
        else:
            # What NN-descent did not find by now is found by brute force.
            graph = written(exact_graph(points, k, cosine - 1e-5), "graph")
        links = written(_links(graph, points, cosine), "links")
        groups = written(connected(links), "groups")
        full = graph.where(F.col("sim") >= cosine - 1e-5).groupBy("a").count().where(F.col("count") >= k).select("a")
        saturated = written(full, "saturated")
        # Lists may be full of nodes just below the threshold; these nodes are components too.
        lone = saturated.join(groups, saturated["a"] == groups["node"], "left_anti").select(F.col("a").alias("node"), F.col("a").alias("component"))
        groups = written(groups.unionByName(lone), "groups")
        bridges = _bridges(groups, saturated, points, cosine)
        if bridges is not None:
            tied = groups.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
            merged = connected(tied.unionByName(bridges))
            groups = written(merged.unionByName(groups.join(merged, "node", "left_anti")), "groups")
        counts = written(_counts(links, points, groups, saturated, cosine), "counts")
        if fit == REFITS:
            break
        others = written(points.select("id").join(counts, "id", "left").select("id", F.coalesce("others", F.lit(0)).alias("others")), "others")
        if audit(others, points, cosine, AUDITED, k, fit) >= WANTED:
            break
    named = points.join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("name").alias("component_id"))
    by_key = written(
        named.join(least, "component").join(counts, "id", "left").select(
            "k1", "k2", "component_id", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
        ),
        "found",
    )
    values = F.transform("embedding", lambda x: x.cast("double"))
    usable_row = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    keyed = rows.select(
        F.col("vec_id").cast("long"),
        F.when(usable_row, F.xxhash64(values)).alias("k1"), F.when(usable_row, F.xxhash64(F.lit(7), values)).alias("k2"),
    )
    return keyed.join(by_key, ["k1", "k2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))

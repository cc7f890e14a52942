"""Nearest neighbours by a hash-prefix forest.

Rows are dealt to shards.  A shard keeps, for every tree, its rows' hash strings (signs of
projections onto random directions) as a sorted array.  A query descends every tree to the
rows with the longest prefix in common with its own string, then ascends in all trees
together, one bit at a time, until enough rows are reached; those are scored exactly.
Inner products become angles by one more component, so that the largest product is the
smallest angle.  The best of all shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.shared import vectors, written

NEAREST = 20
TREES = 64
BITS = 32
REACHED = 0.45  # different rows reached by all trees together, as a share of the shard
LEAST_REACHED = 64
LEAST_SHARDS = 32
SHARD_ROWS = 65_536
SEED = 11
QUERIES_AT_ONCE = 256


def usable(vector: Column) -> Column:
    """Whether a vector is neither null, empty nor zero and all of its components are finite."""
    values = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(values, lambda x: x != 0), F.lit(False))


def usual_width(rows: DataFrame) -> int:
    """The number of components of most vectors (the smaller number of two as frequent)."""
    found = (
        rows.where(usable(F.col("embedding"))).groupBy(F.size("embedding").alias("w")).count()
        .orderBy(F.desc("count"), "w").limit(1).collect()
    )
    return found[0]["w"] if found else 0


class Forest:
    """The trees of one shard."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, trees: int, bits: int, seed: int):
        self.ids, self.values, self.bits = ids, values, bits
        norms = np.linalg.norm(values, axis=1)
        top = norms.max()
        scaled = np.c_[values / top, np.sqrt(np.maximum(0.0, 1 - (norms / top) ** 2))]
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((values.shape[1] + 1, trees * bits)).astype(np.float32)
        self.weights = (np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64))
        codes = self._codes(scaled.astype(np.float32))
        self.orders = [np.argsort(c, kind="stable") for c in codes]
        self.sorted = [c[o] for c, o in zip(codes, self.orders)]

    def _codes(self, points: np.ndarray) -> np.ndarray:
        """(trees, points): the hash strings as numbers."""
        out = []
        for i in range(0, self.planes.shape[1], self.bits):
            out.append((points @ self.planes[:, i : i + self.bits] > 0) @ self.weights)
        return np.array(out, dtype=np.uint64)

    def reached(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """For every query the places of the rows it reaches."""
        units = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        codes = self._codes(np.c_[units, np.zeros(len(units))].astype(np.float32))
        level = np.full(len(queries), self.bits)
        open_ = np.ones(len(queries), bool)
        bounds = self._ranges(codes, level)
        while True:
            counts = sum(hi - lo for lo, hi in bounds)
            open_ &= (counts < enough) & (level > 0)
            if not open_.any():
                break
            level[open_] -= 1  # all trees ascend together
            bounds = self._ranges(codes, level)
        for q in range(len(queries)):
            mask = np.zeros(len(self.ids), bool)
            own = [(lo[q], hi[q]) for lo, hi in bounds]
            while True:
                for order, (lo, hi) in zip(self.orders, own):
                    mask[order[lo:hi]] = True
                if level[q] == 0 or np.count_nonzero(mask) >= enough:
                    break
                level[q] -= 1  # trees have reached the same rows: ascend on
                own = self._ranges(codes[:, q], level[q])
            yield np.flatnonzero(mask)

    def _ranges(self, codes: np.ndarray, level: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every tree the rows that share ``level`` bits with the queries."""
        free = np.asarray(self.bits - level).astype(np.uint64)
        rest = (np.uint64(1) << free) - np.uint64(1)
        found = []
        for code, ordered in zip(codes, self.sorted):
            low = code & ~rest
            found.append((np.searchsorted(ordered, low), np.searchsorted(ordered, low | rest, side="right")))
        return found


def _search(batches: Iterator[pa.RecordBatch], nearest: int, trees: int, bits: int, share: float) -> Iterator[pa.RecordBatch]:
    """Rows come by shard: its rows first, then the queries."""

    def answer(forest: Forest | None, ids: list[int], values: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if forest is None or not ids:
            return
        queries = np.array(values)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        enough = max(LEAST_REACHED, int(np.ceil(share * len(forest.ids))))
        for q, places in enumerate(forest.reached(queries, enough)):
            places = places[forest.ids[places] != ids[q]]
            scores = np.einsum("ij,j->i", forest.values[places], queries[q])
            if len(places) > nearest:
                # All that tie with the last one stay, to be told apart by id.
                last = np.partition(scores, len(scores) - nearest)[len(scores) - nearest]
                good = scores >= last
                places, scores = places[good], scores[good]
            best = np.lexsort((forest.ids[places], -scores))[:nearest]
            out.append((np.full(len(best), ids[q]), forest.ids[places[best]], scores[best]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in zip(*out)], names=["query_id", "vec_id", "score"]
        )

    shard, forest = None, None
    base: list[tuple[np.ndarray, np.ndarray]] = []
    asked_ids: list[int] = []
    asked: list[np.ndarray] = []
    for batch in batches:
        shards, kinds = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        ids = np.asarray(batch.column(2))
        _, values = vectors(batch.column(3))
        cuts = np.r_[0, np.flatnonzero((np.diff(shards) != 0) | (np.diff(kinds) != 0)) + 1, len(ids)]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if shards[i] != shard:
                yield from answer(forest, asked_ids, asked)
                shard, forest, base, asked_ids, asked = shards[i], None, [], [], []
            if kinds[i] == 0:
                base.append((ids[i:j], values[i:j]))
                continue
            if forest is None and base:
                all_ids, all_values = (np.concatenate(x) for x in zip(*base))
                forest, base = Forest(all_ids, all_values, trees, bits, SEED), []
            for at in range(i, j):
                asked_ids.append(int(ids[at]))
                asked.append(values[at])
                if len(asked) >= QUERIES_AT_ONCE:
                    yield from answer(forest, asked_ids, asked)
                    asked_ids, asked = [], []
    yield from answer(forest, asked_ids, asked)


def search(
    rows: DataFrame,
    queries: DataFrame,
    nearest: int = NEAREST,
    trees: int = TREES,
    bits: int = BITS,
    share: float = REACHED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest rows by inner product.

    ``rows`` and ``queries``: vec_id, embedding.  Rows with the query's own vec_id are no
    candidates.  Null ids and vectors that are null, zero, hold null or non-finite
    components or have an unusual number of them take no part.  Ties go to the smaller
    vec_id; repeated rows come up once each.  Scores are in double precision.
    """
    width = usual_width(rows)
    fits = usable(F.col("embedding")) & (F.size("embedding") == width) & F.col("vec_id").isNotNull()
    plain = [F.col("vec_id").cast("long"), F.transform("embedding", lambda x: x.cast("double")).alias("embedding")]
    base, asked = rows.where(fits).select(*plain), queries.where(fits).select(*plain)
    shards = max(LEAST_SHARDS, -(-base.count() // SHARD_ROWS))
    dealt = base.select(
        F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "*"
    ).unionByName(
        asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "*")
    )
    found = dealt.repartition("shard").sortWithinPartitions("shard", "kind", "vec_id").mapInArrow(
        lambda batches: _search(batches, nearest, trees, bits, share), "query_id long, vec_id long, score double"
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, rows: DataFrame, sample: int = 200, nearest: int = NEAREST) -> float:
    """Share of true neighbours found, by brute force for at most ``sample`` queries."""
    ids = [r[0] for r in found.select("query_id").distinct().orderBy(F.xxhash64("query_id")).limit(sample).collect()]
    if not ids:
        return 1.0
    width = usual_width(rows)
    rows = rows.where(usable(F.col("embedding")) & (F.size("embedding") == width) & F.col("vec_id").isNotNull())
    asked = rows.where(F.col("vec_id").isin(ids)).dropDuplicates(["vec_id"]).select("vec_id", "embedding").collect()
    query_ids = np.array([r["vec_id"] for r in asked])
    values = np.array([r["embedding"] for r in asked], dtype=float)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, points = vectors(batch.column(1))
            own = np.asarray(batch.column(0))[good]
            scores = values @ points.T if len(good) else np.zeros((len(values), 0))
            for q, row in enumerate(scores):
                row = np.where(own == query_ids[q], -np.inf, row)
                best = np.lexsort((own, -row))[:nearest]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best), query_ids[q])), pa.array(own[best]), pa.array(row[best])],
                    names=["query_id", "vec_id", "score"],
                )

    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = (
        rows.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(brute, "query_id long, vec_id long, score double")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    )
    hits = true.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hits / max(1, true.count())

"""Connected components by label hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shared import written


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long); component is the smallest node.

    Alternates two steps (Kiveris et al., 2014): every node hands its larger neighbours to
    its smallest one, then its smaller neighbours.  Rows never exceed the edges that came
    in; each round is written to the shared folder.  Null ends and loops are ignored; an
    empty input gives an empty result.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = written(pairs.where("a < b").distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        pairs = written(_small(_large(pairs)), "cc")
        now = pairs.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("node"), F.col("a").alias("component"))
    own = pairs.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return roots.unionByName(own)


def _large(pairs: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of itself and its neighbours."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written, so that both sides of the join are plain shuffles, which adaptive execution can split.
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "cc")
    return (
        both.where("b > a").join(least, "a").where("b != m")
        .select(F.col("m").alias("a"), "b").distinct()
    )


def _small(pairs: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = written(pairs.groupBy("b").agg(F.min("a").alias("m")), "cc")
    moved = pairs.join(least, "b")
    return (
        moved.select(F.col("m").alias("x"), F.col("a").alias("y"))
        .unionByName(moved.select(F.col("m").alias("x"), F.col("b").alias("y")))
        .where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    )

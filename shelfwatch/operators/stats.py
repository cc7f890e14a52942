"""Averages and exact percentiles that stay distributed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.session import kept


def mean_of(total: Column, count: Column, places: int = 2) -> Column:
    """Rounded mean from a sum and a count of present values; null for no values."""
    return F.round(F.try_divide(total, count), places)


def exact_percentiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group and prob.

    The built-in exact percentile keeps every distinct value of a group in one task.
    Here values are counted first (map-side combine), then dealt by range: Spark draws the
    bounds from a sample, so partitions hold about as many different values whatever
    their distribution.  The partitions' counts say in which one a wanted rank lies, and only
    the values of those are ranked.  No task sees more than one partition's values or
    one group's list of partitions.

    Returns the group columns, ``prob`` and ``value`` (double).  Null groups are kept;
    null values and NaN are missing.  ``weight``: how often a row's value counts.
    """
    by = list(by)
    number = F.col(value).cast("double")
    order = [*by, "_value"]
    counted = kept(
        df.where(number.isNotNull() & ~F.isnan(number))
        .select(*by, F.col(value).cast("double").alias("_value"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w"))
        .groupBy(*order).agg(F.sum("_w").alias("_n"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_bucket", F.shiftright(F.monotonically_increasing_id(), 33)),
        "counted",
    )
    per_group = Window.partitionBy(*by)
    running = per_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    # One row for each group and partition.
    buckets = (
        counted.groupBy(*by, "_bucket")
        .agg(F.sum("_n").alias("_in"))
        .select(
            *by, "_bucket",
            (F.sum("_in").over(running) - F.col("_in")).alias("_before"),
            "_in",
            F.sum("_in").over(per_group).alias("_all"),
        )
    )
    # Wanted ranks (0-based) per prob: the two neighbours of (n - 1) * p.
    spots = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("prob"),
                ((F.col("_all") - 1) * F.lit(float(p))).alias("spot"),
            )
            for p in probs
        ]
    )
    wanted = (
        buckets.select(*by, "_bucket", "_before", "_in", F.explode(spots).alias("_s"))
        .select(
            *by, "_bucket", "_before", "_in", F.col("_s.prob").alias("prob"),
            F.floor("_s.spot").alias("_lo"), F.ceil("_s.spot").alias("_hi"),
            (F.col("_s.spot") - F.floor("_s.spot")).alias("_part"),
        )
        .where(
            (F.col("_hi") >= F.col("_before"))
            & (F.col("_lo") < F.col("_before") + F.col("_in"))
        )
    )
    left, right = counted.alias("c"), wanted.alias("w")
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"c.{c}").eqNullSafe(F.col(f"w.{c}")) for c in by]
        + [F.col("c._bucket") == F.col("w._bucket")],
    )
    in_bucket = Window.partitionBy(*by, "prob", "_bucket").orderBy("_value").rowsBetween(
        Window.unboundedPreceding, 0
    )
    ranked = (
        left.join(right, same)
        .select(
            *[F.col(f"c.{c}").alias(c) for c in by], "c._value", "c._n", "w.prob",
            "w._bucket", "w._before", "w._lo", "w._hi", "w._part",
        )
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(in_bucket))
        .withColumn("_from", F.col("_upto") - F.col("_n"))
    )

    def at(rank: str) -> Column:
        hit = (F.col("_from") <= F.col(rank)) & (F.col(rank) < F.col("_upto"))
        return F.max(F.when(hit, F.col("_value")))

    found = ranked.groupBy(*by, "prob").agg(
        at("_lo").alias("_low"), at("_hi").alias("_high"), F.max("_part").alias("_part")
    )
    return found.select(
        *by, "prob",
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("value"),
    )

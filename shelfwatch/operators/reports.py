"""The analytical reports over dimension and snapshot facts.

A snapshot table dwarfs its dimension, and one product may own a large part of it.
Every report that aggregates therefore sums the facts per product first: that step
combines on the map side, so a hot product costs one row per task, and the join with
the dimension and all later steps work on one row per product (and day).  As the
dimension is unique by product, counting those rows replaces a distinct count.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.text import needs_new_name
from shelfwatch.functions import fixed as K
from shelfwatch.operators.stats import mean_of

_MEASURED = {"price": "price", "rating": "rating", "discount": "discount_percent"}


def per_product(fact: DataFrame, *keys: str, measures: dict[str, str] = _MEASURED) -> DataFrame:
    """Sums and counts per product (and further keys)."""
    sums = []
    for name, column in measures.items():
        sums += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    return fact.groupBy("product_id", *keys).agg(F.count(F.lit(1)).alias("n"), *sums)


def mean(name: str) -> Column:
    """Mean over rows of partial sums."""
    return mean_of(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def kpi_summary(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Products, snapshots, averages and the latest snapshot of known products."""
    sums = fact.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("snapshot_timestamp").alias("latest"),
        *[
            a for name, column in _MEASURED.items()
            for a in (F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n"))
        ],
    )
    return sums.join(dim.select("product_id"), "product_id").agg(
        F.count(F.lit(1)).alias("total_products"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_snapshots"),
        mean("price").alias("avg_price"),
        mean("rating").alias("avg_rating"),
        mean("discount").alias("avg_discount_percent"),
        F.max("latest").alias("latest_snapshot"),
    )


def by_device_brand(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Products and averages per device type and brand, most products first."""
    return (
        per_product(fact)
        .join(dim.select("product_id", "device_type", "brand"), "product_id")
        .groupBy("device_type", "brand")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            mean("price").alias("avg_price"),
            mean("rating").alias("avg_rating"),
            mean("discount").alias("avg_discount_percent"),
        )
        .orderBy(F.desc("product_count"), "device_type", "brand")
    )


def daily_price_trend(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Average price and snapshots per day, device type and brand."""
    return (
        per_product(fact, "snapshot_date", measures={"price": "price"})
        .join(dim.select("product_id", "device_type", "brand"), "product_id")
        .groupBy("snapshot_date", "device_type", "brand")
        .agg(mean("price").alias("avg_price"), F.sum("n").alias("snapshot_count"))
        .orderBy("snapshot_date", "device_type", "brand")
    )


def top_rated(dim: DataFrame, fact: DataFrame, n: int = 20) -> DataFrame:
    """Best average rating, then highest average price; unrated groups come first."""
    keys = ("product_name", "title", "brand", "device_type")
    return (
        per_product(fact, measures={"price": "price", "rating": "rating"})
        .join(dim.select("product_id", *keys), "product_id")
        .groupBy(*keys)
        .agg(mean("rating").alias("avg_rating"), mean("price").alias("avg_price"))
        .orderBy(F.desc_nulls_first("avg_rating"), F.desc_nulls_first("avg_price"), *keys)
        .limit(n)
    )


def price_changes(dim: DataFrame, fact: DataFrame, n: int = 20) -> DataFrame:
    """Products with the widest range between lowest and highest price."""
    keys = ("product_name", "title", "brand", "device_type")
    ranges = (
        fact.groupBy("product_id")
        .agg(F.min("price").alias("min_price"), F.max("price").alias("max_price"))
        .where(F.col("min_price").isNotNull())
    )
    return (
        ranges.join(dim.select("product_id", *keys), "product_id")
        .select(*keys, "min_price", "max_price",
                F.round(F.col("max_price") - F.col("min_price"), 2).alias("price_change"),
                "product_id")
        .orderBy(F.desc("price_change"), "product_id")
        .limit(n)
        .drop("product_id")
    )


_LEAST_RANK = -(1 << 63)


def _offer_rank() -> Column:
    """One whole number that orders offers: discount, then the lower price, a missing one last.

    Discounts and prices are DECIMAL(5,2) and DECIMAL(10,2): prices stay below 10^10 cents.
    """
    discount = (F.col("discount_percent").cast("decimal(5,2)") * 100).cast("long")
    price = (F.col("price").cast("decimal(10,2)") * 100).cast("long")
    return discount * 100_000_000_000 + F.coalesce(F.lit(50_000_000_000) - price, F.lit(0))


def best_discounts(dim: DataFrame, fact: DataFrame, n: int = 20) -> DataFrame:
    """Single snapshots with the highest discount, cheapest first among equals.

    Joining every discounted fact only to keep ``n`` would shuffle the fact table.  Each
    product's best offer is found first (one row per product and task), and the ``n`` best
    of products that exist bound the answer from below: only facts at least that good
    are joined.  Facts without product take no part in the bound, so they change
    neither plan nor work.  With fewer than ``n`` products, all their facts are joined.
    """
    shown = ("price", "original_price", "discount_percent", "availability", "seller",
             "snapshot_timestamp")
    offers = fact.where(F.col("discount_percent").isNotNull()).select("product_id", *shown, _offer_rank().alias("_rank"))
    best = offers.groupBy("product_id").agg(F.max("_rank").alias("_rank"))
    # At most n rows.
    front = best.join(dim.select("product_id"), "product_id").orderBy(F.desc("_rank")).limit(n)
    bound = front.agg(F.when(F.count(F.lit(1)) >= n, F.min("_rank")).alias("worst"))
    good = offers.where(F.col("_rank") >= F.coalesce(bound.scalar(), F.lit(_LEAST_RANK)))
    keys = ("product_name", "brand", "device_type")
    return (
        good.join(dim.select("product_id", *keys), "product_id")
        .select(*keys, *shown)
        .orderBy(F.desc("discount_percent"), F.asc_nulls_last("price"), *keys,
                 "original_price", "availability", "seller", "snapshot_timestamp")
        .limit(n)
    )


def name_audit(dim: DataFrame) -> DataFrame:
    """Products whose name is missing, too long or ends in a noise word.

    Words are pieces between single blanks here, so a double blank counts as a word.
    """
    name = F.trim("product_name")
    pieces = F.length(name) - F.length(F.replace(name, F.lit(" "), F.lit(""))) + 1
    last = F.substring_index(name, " ", -1)
    return dim.where(
        F.col("product_name").isNull()
        | (name == "")
        | (pieces > K.NAME_MAX_WORDS)
        | F.lower(last).isin(*K.NAME_TRAILING_WORDS)
        | last.rlike(r"^[0-9]+([.,][0-9]+)?\z")
    ).select("product_id", "sku", "product_name", "title")


def stale_names(dim: DataFrame) -> DataFrame:
    """Products whose name has to be rebuilt (words split at any white space)."""
    return dim.where(needs_new_name(F.col("product_name")))


def table_counts(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows per table and the latest snapshot, one row per table."""
    return dim.agg(
        F.lit("dim_products").alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(None).cast("timestamp_ntz").alias("latest_snapshot"),
    ).unionByName(
        fact.agg(
            F.lit("fact_product_snapshots").alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.max("snapshot_timestamp").alias("latest_snapshot"),
        )
    )


def latest_snapshots(fact: DataFrame, n: int = 20) -> DataFrame:
    """The newest snapshots; ties are settled by all shown columns."""
    shown = ("price", "original_price", "discount_percent", "availability", "seller")
    return (
        fact.orderBy(F.desc_nulls_first("snapshot_timestamp"),
                     *[F.asc_nulls_first(c) for c in shown])
        .limit(n)
        .select(*shown, "snapshot_timestamp")
    )


def named_products(dim: DataFrame, n: int = 20) -> DataFrame:
    """A look at products that have a name."""
    shown = ("sku", "product_name", "brand", "device_type", "model_number", "storage_capacity")
    return (
        dim.where(F.col("product_name").isNotNull())
        .select(*[c for c in shown if c in dim.columns])
        .orderBy("sku")
        .limit(n)
    )


def freshness(fact: DataFrame, now: datetime, max_age_hours: float = K.MAX_AGE_HOURS) -> DataFrame:
    """Latest snapshot, its age in hours (exact and by hour boundaries), verdicts.

    ``fresh`` follows the exact age, ``fresh_by_hour`` the boundary count; a table
    without snapshots is fresh by neither.
    """
    at = F.lit(now).cast("timestamp_ntz")
    latest = F.col("latest_snapshot")
    seconds = F.timestamp_diff("SECOND", latest, at)
    hours = F.timestamp_diff("HOUR", F.date_trunc("hour", latest), F.date_trunc("hour", at))
    return (
        fact.agg(F.max("snapshot_timestamp").alias("latest_snapshot"))
        .withColumn("age_hours", seconds / F.lit(3600.0))
        .withColumn("hours_crossed", hours)
        .withColumn("fresh", F.coalesce(F.col("age_hours") <= max_age_hours, F.lit(False)))
        .withColumn("fresh_by_hour", F.coalesce(F.col("hours_crossed") <= max_age_hours, F.lit(False)))
    )

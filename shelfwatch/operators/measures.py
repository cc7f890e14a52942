"""Dashboard measures and the data sets behind the dashboard pages.

A slicer is a list of group-by keys.  As in the reports, facts are summed per product
before the join, so that distinct product counts become plain counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.functions import fixed as K
from shelfwatch.operators.reports import mean, per_product

OTHER = "other"
DIM_KEYS = ("product_name", "title", "brand", "device_type")


def _product_sums(fact: DataFrame, keys: Sequence[str], high_discount: float) -> DataFrame:
    discount = F.col("discount_percent")
    return fact.groupBy("product_id", *keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[
            a for name, column in (
                ("price", "price"), ("rating", "rating"), ("discount", "discount_percent"),
                ("original", "original_price"),
            )
            for a in (F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n"))
        ],
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        F.max("snapshot_timestamp").alias("latest"),
        F.max((discount > 0).cast("int")).alias("discounted"),
        F.max((discount >= high_discount).cast("int")).alias("deep"),
    )


def measures(
    dim: DataFrame,
    fact: DataFrame,
    by: Sequence[str] = (),
    high_discount: float = K.HIGH_DISCOUNT,
) -> DataFrame:
    """All base measures per slicer value (one row without slicers).

    Slicers may be product attributes, snapshot columns or both.  With a snapshot
    column as slicer a product counts once per slicer value, as a distinct count does.
    """
    dim_keys = [k for k in by if k in dim.columns and k != "product_id"]
    fact_keys = [k for k in by if k not in dim_keys and k != "product_id"]
    sums = _product_sums(fact, fact_keys, high_discount)
    span = F.col("max_price") - F.col("min_price")
    return (
        sums.join(dim.select("product_id", *dim_keys), "product_id")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("total_products"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_snapshots"),
            mean("price").alias("average_price"),
            mean("rating").alias("average_rating"),
            mean("discount").alias("average_discount"),
            mean("original").alias("average_original_price"),
            F.max("latest").alias("latest_snapshot"),
            F.max("high").alias("max_price"),
            F.min("low").alias("min_price"),
            F.coalesce(F.sum("discounted"), F.lit(0)).alias("discounted_products"),
            F.coalesce(F.sum("deep"), F.lit(0)).alias("high_discount_products"),
        )
        .withColumn("price_range", span)
        .withColumn("price_change_percent", F.try_divide(F.col("price_range"), F.col("min_price")))
    )


def freshness_status(fact: DataFrame, now: datetime) -> DataFrame:
    """Days (by day boundary) since the last snapshot: at most one is fresh."""
    days = F.date_diff(F.lit(now.date()), F.col("latest_snapshot").cast("date"))
    return (
        fact.agg(F.max("snapshot_timestamp").alias("latest_snapshot"))
        .withColumn("days_since_last_snapshot", days.cast("long"))
        .withColumn(
            "freshness_status",
            F.when(F.col("days_since_last_snapshot") <= 1, F.lit("Fresh")).otherwise(F.lit("Stale")),
        )
    )


def quality_score(report: DataFrame) -> DataFrame:
    """Share of quality rules that passed (a rule passes if all its rows do)."""
    return (
        report.groupBy("rule").agg(F.max("bad_rows").alias("bad"))
        .agg(F.avg((F.col("bad") == 0).cast("double")).alias("data_quality_score"))
    )


def products_by(dim: DataFrame, fact: DataFrame, *keys: str) -> DataFrame:
    """Products with snapshots per key, with their share of all of them in percent."""
    seen = fact.select("product_id").distinct()
    counted = (
        seen.join(dim.select("product_id", *keys), "product_id")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("products"))
    )
    total = counted.agg(F.sum("products").alias("n")).scalar()
    return counted.withColumn(
        "share_percent", F.round(F.col("products") * F.lit(100).cast("decimal(20,0)") / total, 2)
    ).orderBy(F.desc("products"), *keys)


def device_brand_matrix(
    dim: DataFrame, fact: DataFrame, devices: Sequence[str]
) -> DataFrame:
    """Products by brand (rows) and device type (columns, given in advance).

    Products of other device types, and of none, count in the column ``other``.
    """
    seen = fact.select("product_id").distinct()
    listed = F.when(F.col("device_type").isin(*devices), F.col("device_type")).otherwise(OTHER)
    return (
        seen.join(dim.select("product_id", "brand", listed.alias("device_type")), "product_id")
        .groupBy("brand").pivot("device_type", [*devices, OTHER])
        .agg(F.count(F.lit(1)))
        .na.fill(0)
        .orderBy("brand")
    )


def price_over_time(dim: DataFrame, fact: DataFrame, *keys: str) -> DataFrame:
    """Average price per snapshot time, for all products or per product attribute."""
    sums = per_product(fact, "snapshot_timestamp", measures={"price": "price"})
    return (
        sums.join(dim.select("product_id", *keys), "product_id")
        .groupBy("snapshot_timestamp", *keys)
        .agg(mean("price").alias("average_price"))
        .orderBy("snapshot_timestamp", *keys)
    )


def snapshot_growth(fact: DataFrame) -> DataFrame:
    """Snapshots per day and the running total.

    The running sum is over one row per day, whatever the size of the fact table.
    """
    running = Window.partitionBy().orderBy("snapshot_date").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        fact.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("snapshots"))
        .withColumn("total_snapshots", F.sum("snapshots").over(running))
        .orderBy("snapshot_date")
    )


def price_vs_discount(dim: DataFrame, fact: DataFrame, *keys: str) -> DataFrame:
    """Average price against average discount (scatter plot), by product or brand."""
    return (
        per_product(fact, measures={"price": "price", "discount": "discount_percent"})
        .join(dim.select("product_id", *keys), "product_id")
        .groupBy(*keys)
        .agg(mean("price").alias("average_price"), mean("discount").alias("average_discount"))
        .orderBy(*keys)
    )


def product_details(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Product, seller and status combinations with snapshots and average price."""
    keys = ("seller", "availability")
    names = ("product_name", "device_type", "brand")
    return (
        per_product(fact, *keys, measures={"price": "price", "rating": "rating"})
        .join(dim.select("product_id", *names), "product_id")
        .groupBy(*names, *keys)
        .agg(
            F.sum("n").alias("snapshots"),
            mean("price").alias("average_price"),
            mean("rating").alias("average_rating"),
        )
    )


def quality_checks(dim: DataFrame, fact: DataFrame, now: datetime) -> DataFrame:
    """The dashboard's check table: check, bad rows, passed."""
    def long(df: DataFrame) -> DataFrame:
        names = df.columns
        return df.select(
            F.explode(F.create_map(*[c for n in names for c in (F.lit(n), F.col(n))]))
            .alias("check_name", "bad_rows")
        )

    def count(condition: Column) -> Column:
        return F.count_if(condition)

    extra = dim.groupBy("sku").agg((F.count(F.lit(1)) - 1).alias("extra"))
    age = freshness_status(fact, now).select(
        (F.col("freshness_status") != "Fresh").cast("long").alias("warehouse_freshness")
    )
    parts = [
        long(extra.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_sku"))),
        long(dim.agg(count(F.coalesce(F.trim("brand") == "", F.lit(True))).alias("missing_brand"))),
        long(fact.agg(
            count(F.col("price").isNull()).alias("missing_price"),
            count(~F.col("rating").between(0, 5)).alias("invalid_ratings"),
        )),
        long(age),
    ]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined.withColumn("passed", F.col("bad_rows") == 0)


PAGES = {
    "products_by_brand": lambda dim, fact: products_by(dim, fact, "brand"),
    "products_by_device": lambda dim, fact: products_by(dim, fact, "device_type"),
    "products_by_device_brand": lambda dim, fact: products_by(dim, fact, "device_type", "brand"),
    "price_by_brand": lambda dim, fact: measures(dim, fact, ["brand"]).select("brand", "average_price"),
    "price_over_time": lambda dim, fact: price_over_time(dim, fact),
    "price_over_time_by_device": lambda dim, fact: price_over_time(dim, fact, "device_type"),
    "price_over_time_by_brand": lambda dim, fact: price_over_time(dim, fact, "brand"),
    "price_change_by_product": lambda dim, fact: measures(dim, fact, ["product_name"]).select(
        "product_name", "price_range", "price_change_percent"
    ),
    "snapshot_growth": lambda dim, fact: snapshot_growth(fact),
    "price_vs_discount_by_product": lambda dim, fact: price_vs_discount(dim, fact, "product_name", "brand"),
    "price_vs_discount_by_brand": lambda dim, fact: price_vs_discount(dim, fact, "brand"),
    "product_details": product_details,
}


def page_dataset(name: str, dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Data set of one dashboard visual, by name."""
    if name not in PAGES:
        raise KeyError(f"unknown page data set: {name}; known: {', '.join(PAGES)}")
    return PAGES[name](dim, fact)

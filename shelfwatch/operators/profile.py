"""Profiles of a clean batch: audits, counts, percentiles, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions import fixed as K
from shelfwatch.functions.text import is_blank, is_word_of
from shelfwatch.session import dealt, kept
from shelfwatch.operators.stats import exact_percentiles

NOT_AVAILABLE = "Not available"
COMPLETENESS_COLUMNS = (
    "seller", "availability", "original_price", "discount_percent", "brand",
    "product_name", "product_url", "image_url",
)
TOP_KINDS = {
    "price": ("price",),
    "discount": ("discount_percent",),
    "rating": ("rating", "price"),
}


def _as_text(df: DataFrame, column: str) -> Column:
    return F.col(column).cast("string")


def unavailable(col: Column) -> Column:
    """Null, or one of the profile's missing tokens."""
    return F.coalesce(is_word_of(col, K.PROFILE_MISSING), F.lit(True))


def _long_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) for every cell, as text."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), _as_text(df, c).alias("value"))
            for c in columns
        ]
    )
    return dealt(df.select(*columns)).select(F.inline(cells))


def column_audit(df: DataFrame) -> DataFrame:
    """Required and extra columns: whether they are there, and rows that fill them."""
    extra = [c for c in df.columns if c not in schemas.REQUIRED_COLUMNS]
    listed = [*schemas.REQUIRED_COLUMNS, *extra]
    counts = df.agg(
        *[(F.count(c) if c in df.columns else F.lit(0).cast("long")).alias(f"c{i}")
          for i, c in enumerate(listed)]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(c in schemas.REQUIRED_COLUMNS).alias("is_required"),
                F.lit(c in df.columns).alias("is_present"),
                F.col(f"c{i}").alias("filled_rows"),
            )
            for i, c in enumerate(listed)
        ]
    )
    return counts.select(F.inline(entries))


def quality_summary(df: DataFrame) -> DataFrame:
    """Ten counts, one row per metric."""
    price, original = F.col("price"), F.col("original_price")

    def over_all(test) -> Column:
        total = F.lit(0).cast("long")
        for c in df.columns:
            total = total + F.count_if(test(c))
        return total

    df = dealt(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        over_all(lambda c: F.col(c).isNull()).alias("total_null_cells"),
        over_all(lambda c: is_blank(_as_text(df, c))).alias("total_blank_cells"),
        F.count_if(price.isNull()).alias("price_null_rows"),
        F.count_if(price <= 0).alias("price_lte_zero_rows"),
        F.count_if(~F.col("rating").between(0, 5)).alias("rating_outside_0_5_rows"),
        F.count_if(~F.col("discount_percent").between(0, 100)).alias("discount_outside_0_100_rows"),
        F.count_if(original < price).alias("original_price_lower_than_price_rows"),
    )
    extra = df.groupBy("sku").agg((F.count(F.lit(1)) - 1).alias("more")).agg(
        F.coalesce(F.sum("more"), F.lit(0)).alias("duplicate_sku_rows")
    )
    return _metrics(counts).unionByName(_metrics(extra))


def _metrics(one_row: DataFrame, kind: str = "long") -> DataFrame:
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast(kind).alias("value"))
            for c in one_row.columns
        ]
    )
    return one_row.select(F.inline(entries))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type, nulls, distinct values and missing tokens per column.

    Cells are counted by (column, value) first.  That combines on the map side and
    spreads a column's distinct values over all tasks, where many exact distinct counts
    in one aggregate would copy each wide row once per column.
    """
    columns = list(columns or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    value = F.col("value")
    per_value = _long_cells(df, columns).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    profile = per_value.groupBy("column_name").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(value.isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("unique_count"),
        F.coalesce(F.sum(F.when(unavailable(value), F.col("n"))), F.lit(0)).alias("not_available_count"),
    )
    dtype = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(types[c]))])
    return profile.select(
        "column_name",
        dtype[F.col("column_name")].alias("dtype"),
        "null_count",
        F.round(F.col("null_count") * F.lit(100).cast("decimal(20,0)") / F.col("rows"), 2)
        .cast("double").alias("null_percent"),
        "unique_count",
        "not_available_count",
    ).orderBy(F.desc("null_count"), F.desc("not_available_count"), "column_name")


def overview(df: DataFrame) -> DataFrame:
    """Distinct counts, available counts and price level, one row per metric."""
    distinct = column_profile(df, ["sku", "device_type", "brand", "seller"]).select(
        F.create_map(
            F.lit("sku"), F.lit("unique_sku"), F.lit("device_type"), F.lit("device_types"),
            F.lit("brand"), F.lit("brands"), F.lit("seller"), F.lit("sellers"),
        )[F.col("column_name")].alias("metric"),
        F.col("unique_count").cast("double").alias("value"),
    )
    counts = df.agg(
        F.count_if(~unavailable(F.col("seller"))).alias("products_with_seller"),
        F.count_if(~unavailable(F.col("availability"))).alias("products_with_availability"),
        F.count_if(F.col("discount_percent") > 0).alias("products_with_discount_gt_0"),
        F.avg("price").alias("avg_price"),
        F.max("price").alias("max_price"),
    )
    median = exact_percentiles(df, "price", [0.5]).select(
        F.lit("median_price").alias("metric"), "value"
    )
    return distinct.unionByName(_metrics(counts, "double")).unionByName(median)


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties by name; null has a label."""
    counted = (
        df.groupBy(F.coalesce(F.col(column), F.lit(NOT_AVAILABLE)).alias(column))
        .agg(F.count(F.lit(1)).alias("products"))
        .orderBy(F.desc("products"), column)
    )
    return counted if n is None else counted.limit(n)


def describe(
    df: DataFrame,
    columns: Sequence[str] = schemas.CLEAN_NUMBERS,
    probs: Sequence[float] = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99),
) -> DataFrame:
    """count, mean, std, min, percentiles, max; one row per column.

    The columns are stacked and grouped, so all are done in one pass.
    """
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns]
    )
    long = df.select(F.inline(cells))
    moments = long.groupBy("column_name").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"),
    )
    names = {float(p): f"p{round(p * 100):02d}" for p in probs}
    spread = (
        exact_percentiles(long, "x", probs, by=["column_name"])
        .groupBy("column_name")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in names.items()])
    )
    return moments.join(spread, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", *names.values(), "max"
    )


def price_by_device(df: DataFrame) -> DataFrame:
    """Products and price level per device type (null kept), most products first."""
    stats = df.groupBy("device_type").agg(
        F.count("sku").alias("products"), F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.avg("discount_percent").alias("avg_discount"),
    )
    medians = exact_percentiles(df, "price", [0.5], by=["device_type"]).select(
        F.col("device_type").alias("_d"), F.col("value").alias("median_price")
    )
    return (
        stats.join(medians, F.col("device_type").eqNullSafe(F.col("_d")), "left")
        .select("device_type", "products", "median_price", "avg_price", "min_price",
                "max_price", "avg_discount")
        .orderBy(F.desc("products"), F.asc_nulls_last("device_type"))
    )


def histogram(df: DataFrame, column: str, bins: int, clip: float | None = None) -> DataFrame:
    """Equal-width bins over the value range; the right edge is in the last bin.

    ``clip`` first cuts values down to that percentile.  Empty bins are listed with 0.  The
    different values are counted once; percentile, range and bins come from the counts.
    """
    spark = df.sparkSession
    number = F.col(column).cast("double")
    counted = kept(df.where(number.isNotNull() & ~F.isnan(number)).groupBy(number.alias("x")).agg(F.count(F.lit(1)).alias("n")), "counted")
    values = counted
    if clip is not None:
        top = exact_percentiles(counted, "x", [clip], weight="n").first()
        values = values.withColumn("x", F.least(F.col("x"), F.lit(top["value"] if top else None).cast("double")))
    lo, hi = values.agg(F.min("x"), F.max("x")).first()
    if lo is None:
        return spark.createDataFrame([], "bin long, from_value double, to_value double, rows long")
    low, width = F.lit(float(lo)), F.lit((float(hi) - float(lo)) / bins)
    if hi > lo:
        place = F.least(F.floor((F.col("x") - low) * bins / F.lit(float(hi) - float(lo))) + 1, F.lit(bins))
    else:
        place = F.lit(bins // 2 + 1)
    rows = values.groupBy(place.cast("long").alias("bin")).agg(F.sum("n").alias("rows"))
    return (
        spark.range(1, bins + 1).withColumnRenamed("id", "bin").join(rows, "bin", "left")
        .select(
            "bin", (low + width * (F.col("bin") - 1)).alias("from_value"), (low + width * F.col("bin")).alias("to_value"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
        .orderBy("bin")
    )


def discount_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(df.where(F.col("discount_percent") > 0), "discount_percent", bins)


def price_histogram(df: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(df, "price", bins, clip=0.99)


def top_products(df: DataFrame, kind: str, n: int = 10) -> DataFrame:
    """Highest by ``price``, ``discount`` or ``rating``; missing values last."""
    shown = [
        c for c in ("sku", "title", "brand", "device_type", "price", "original_price",
                    "discount_percent", "rating", "seller", "availability", "product_url")
        if c in df.columns
    ]
    keys = TOP_KINDS[kind]
    rest = [c for c in shown if c not in keys]
    return (
        df.select(*shown)
        .orderBy(*[F.desc_nulls_last(k) for k in keys], *rest)
        .limit(n)
    )


def completeness(df: DataFrame, columns: Sequence[str] = COMPLETENESS_COLUMNS) -> DataFrame:
    """Available and unavailable rows per column, least complete first."""
    columns = [c for c in columns if c in df.columns]
    counts = dealt(df.select(*columns)).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(unavailable(_as_text(df, c))).alias(f"c{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                (F.col("rows") - F.col(f"c{i}")).alias("available_rows"),
                F.col(f"c{i}").alias("unavailable_or_blank_rows"),
                F.round(
                    (F.col("rows") - F.col(f"c{i}")) * F.lit(100).cast("decimal(20,0)")
                    / F.nullif(F.col("rows"), F.lit(0)), 2,
                ).cast("double").alias("available_percent"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(F.inline(entries)).orderBy("available_percent", "column_name")

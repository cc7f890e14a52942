"""Raw records to clean batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch import schemas
from shelfwatch.functions import classify, numbers, text


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the schema's absent columns as nulls; keep all others."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def scored(raw: DataFrame) -> DataFrame:
    """Prices, discount and rating as numbers; device type and brand corrected."""
    raw = raw.withColumns(
        {
            "price": numbers.clean_price(F.col("price")),
            "original_price": numbers.clean_price(F.col("original_price")),
        }
    )
    category = F.col("category")
    raw = raw.withColumns(
        {
            "discount_percent": numbers.final_discount(
                F.col("discount_percent"), F.col("price"), F.col("original_price")
            ),
            "rating": numbers.rating_score(F.col("rating")),
            "sku": F.col("asin"),
            "product_name": text.product_name(F.col("title")),
            "device_type": classify.corrected_device(
                F.col("title"), category, text.capitalize(category)
            ),
        }
    )
    return raw.withColumn(
        "brand",
        classify.corrected_brand(
            F.col("title"), F.col("brand"), F.col("manufacturer"), F.col("device_type")
        ),
    )


def to_clean(df: DataFrame, *extra: str) -> DataFrame:
    """The clean columns in their fixed order; texts squeezed."""
    return df.select(
        *extra,
        *[
            text.clean_text(F.col(c)).alias(c) if c in schemas.CLEAN_TEXTS else F.col(c)
            for c in schemas.CLEAN_COLUMNS
        ],
    )


def with_required(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["sku", "price"])


def fill_defaults(df: DataFrame) -> DataFrame:
    """Original price from price; discount and rating 0."""
    return df.withColumns(
        {
            "original_price": F.coalesce("original_price", "price"),
            "discount_percent": F.coalesce("discount_percent", F.lit(0.0)),
            "rating": F.coalesce("rating", F.lit(0.0)),
        }
    )


def repair_prices(df: DataFrame) -> DataFrame:
    """An original price below the price is replaced, its discount set to 0."""
    inverted = F.col("original_price") < F.col("price")
    return df.withColumns(
        {
            "original_price": F.when(inverted, F.col("price")).otherwise(F.col("original_price")),
            "discount_percent": F.when(inverted, F.lit(0.0)).otherwise(F.col("discount_percent")),
        }
    )


def fill_texts(df: DataFrame) -> DataFrame:
    """Placeholders for missing texts; stock status cleaned."""
    return df.withColumns(
        {
            c: text.clean_availability(F.col(c)) if c == "availability"
            else text.or_placeholder(F.col(c))
            for c in schemas.CLEAN_TEXTS
        }
    )


def keep_one(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark keeps one row per key and task before the shuffle (window group limit), so a
    key holding a third of all rows costs its task one row per input task.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")


def dedup_first(df: DataFrame, key: str = "sku", order: str = "seq") -> DataFrame:
    return keep_one(df, key, [F.col(order)])


def dedup_last(df: DataFrame, key: str = "sku", order: str = "seq") -> DataFrame:
    return keep_one(df, key, [F.col(order).desc()])


def transform(raw: DataFrame) -> DataFrame:
    """Raw records (with ``seq``) to the clean batch, one row per sku, ``seq`` kept.

    Duplicates are settled on the numbers alone before the costly text rules run on the
    survivors: a row only needs a sku and a price to count as the first of its sku.
    """
    raw = ensure_columns(raw, schemas.RAW_SCHEMA)
    has_price = numbers.clean_price(F.col("price")).isNotNull()
    firsts = keep_one(raw.where(F.col("asin").isNotNull() & has_price), "asin", [F.col("seq")])
    return (
        firsts.transform(scored)
        .transform(to_clean, "seq")
        .transform(with_required)
        .transform(fill_defaults)
        .transform(repair_prices)
        .transform(fill_texts)
    )

"""Table shapes.  All are fixed; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

SPEC_COLUMNS = (
    "model_number", "color", "screen_size", "ram_memory", "storage_capacity",
    "processor", "gpu", "operating_system", "display_resolution", "connectivity",
    "product_dimensions", "item_weight",
)
DETAIL_FIELDS = (
    "brand", "manufacturer", *SPEC_COLUMNS, "availability", "seller", "price",
    "original_price", "discount_percent", "product_description", "bullet_points",
    "product_specs",
)
LISTING_FIELDS = (
    "asin", "title", "price", "original_price", "rating", "image_url",
    "product_url", "category", "source_search_term", "listing_badges",
)

_ARRAYS = {"listing_badges", "bullet_points"}
_MAPS = {"product_specs"}


def _raw_type(name: str) -> T.DataType:
    if name in _ARRAYS:
        return T.ArrayType(T.StringType())
    if name in _MAPS:
        return T.MapType(T.StringType(), T.StringType())
    return T.StringType()


RAW_FIELDS = tuple(dict.fromkeys(LISTING_FIELDS + DETAIL_FIELDS))
RAW_SCHEMA = T.StructType([T.StructField(n, _raw_type(n)) for n in RAW_FIELDS])
DETAIL_SCHEMA = T.StructType([T.StructField(n, _raw_type(n)) for n in DETAIL_FIELDS])
LISTING_SCHEMA = T.StructType([T.StructField(n, _raw_type(n)) for n in LISTING_FIELDS])

# Names used inside the engine -> names at the CSV edge.
EDGE_NAMES = {"product_name": "Product Name", "device_type": "Device type"}

CLEAN_COLUMNS = (
    "sku", "title", "product_name", "brand", "price", "original_price",
    "discount_percent", "rating", "availability", "seller", "product_url",
    "image_url", "device_type", *SPEC_COLUMNS,
)
CLEAN_NUMBERS = ("price", "original_price", "discount_percent", "rating")
CLEAN_TEXTS = tuple(c for c in CLEAN_COLUMNS if c != "sku" and c not in CLEAN_NUMBERS)
REQUIRED_COLUMNS = CLEAN_COLUMNS[:13]
CLEAN_SCHEMA = T.StructType(
    [
        T.StructField(n, T.DoubleType() if n in CLEAN_NUMBERS else T.StringType())
        for n in CLEAN_COLUMNS
    ]
)

DIM_ATTRIBUTES = (
    "title", "product_name", "brand", "device_type", *SPEC_COLUMNS,
    "product_url", "image_url",
)
DIM_SCHEMA = T.StructType(
    [T.StructField("product_id", T.LongType()), T.StructField("sku", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in DIM_ATTRIBUTES]
    + [
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)
FACT_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("currency", T.StringType()),
        T.StructField("original_price", T.DecimalType(10, 2)),
        T.StructField("discount_percent", T.DecimalType(5, 2)),
        T.StructField("rating", T.DecimalType(3, 2)),
        T.StructField("availability", T.StringType()),
        T.StructField("seller", T.StringType()),
        T.StructField("snapshot_timestamp", T.TimestampNTZType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
FACT_TEXTS = ("availability", "seller")

# Columns of older warehouses that are dropped on evolution.
RETIRED_DIM_COLUMNS = (
    "platform", "best_sellers_rank", "brand_validation_status",
    "device_type_validation_status", "data_quality_score", "validation_notes",
)
RETIRED_FACT_COLUMNS = ("review_count", "is_sponsored", "is_prime")

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

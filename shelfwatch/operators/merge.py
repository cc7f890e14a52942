"""Merging raw batches and detail records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch import schemas
from shelfwatch.functions.urls import asin_key, identity
from shelfwatch.operators.clean import keep_one
from shelfwatch.session import shuffled


def has_value(col: Column, kind: T.DataType) -> Column:
    """Not null, not empty text, not an empty list or map.  "0" is a value."""
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(col) > 0, F.lit(False))
    if isinstance(kind, T.StringType):
        return F.coalesce(col != "", F.lit(False))
    return col.isNotNull()


def _last_value(col: Column, kind: T.DataType, seq: Column) -> Column:
    """Last non-empty value.  The latest pair of (seq, value) is kept, which combines
    on the map side, so a product seen in a third of all rows is no hot spot."""
    kept = F.when(has_value(col, kind), col)
    if isinstance(kind, T.MapType):
        # Maps cannot be compared; they travel as their entries.
        pair = F.when(kept.isNotNull(), F.struct(seq, F.map_entries(kept).alias("v")))
        return F.map_from_entries(F.max(pair)["v"])
    return F.max_by(kept, F.when(kept.isNotNull(), seq))


def merge_batches(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Field by field, the last non-empty value of each product wins.

    Both sides carry ``seq``, their order; new rows come after all existing ones.  The
    result's ``seq`` is a product's first appearance.  If one side has no rows, the other
    one is returned as merged by itself would not be: rows stay as they are.
    """
    fields = [f for f in schemas.RAW_SCHEMA if f.name in existing.columns or f.name in new.columns]
    order = F.struct(F.col("_side"), F.col("seq"))

    def side(df: DataFrame, number: int) -> DataFrame:
        return df.select(
            F.lit(number).alias("_side"), "seq",
            *[
                F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in fields
            ],
        )

    rows = side(existing, 0).unionByName(side(new, 1))
    url = F.col("product_url") if any(f.name == "product_url" for f in fields) else F.lit("")
    row_id = F.concat_ws("/", F.col("_side").cast("string"), F.col("seq").cast("string"))
    merged = rows.groupBy(identity(F.col("asin"), url, row_id).alias("identity")).agg(
        F.min(order).alias("_first"),
        *[_last_value(F.col(f.name), f.dataType, order).alias(f.name) for f in fields],
    )
    return merged.select(
        "identity",
        F.col("_first._side").cast("int").alias("batch"),
        F.col("_first.seq").alias("seq"),
        *[f.name for f in fields],
    )


def merged_rows(rows: DataFrame, landing: int) -> DataFrame:
    """The products of one landing: identity, landing, seq (first appearance), last non-empty values."""
    key = identity(F.col("asin"), F.col("product_url"), F.concat_ws("/", F.lit(str(landing)), F.col("seq").cast("string")))
    return rows.groupBy(key.alias("identity")).agg(
        F.min("seq").alias("seq"),
        *[_last_value(F.col(f.name), f.dataType, F.col("seq")).alias(f.name) for f in schemas.RAW_SCHEMA],
    ).select("identity", F.lit(landing).cast("long").alias("landing"), "seq", *schemas.RAW_SCHEMA.fieldNames())


def into_products(products: DataFrame, new: DataFrame) -> DataFrame:
    """``products`` with what a landing says about them, and with the landing's new products.

    Both sides have one row per identity: values that the landing has win, first appearances stay.
    """
    fields = {f.name: f.dataType for f in schemas.RAW_SCHEMA}
    old = products.select("identity", *[F.col(c).alias(f"_{c}") for c in products.columns if c != "identity"])
    both = old.join(new, "identity", "full")
    seen = F.col("_landing").isNotNull()
    return both.select(
        "identity",
        *[F.when(seen, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in products.columns if c not in fields and c != "identity"],
        *[F.when(has_value(F.col(c), kind), F.col(c)).otherwise(F.coalesce(f"_{c}", c)).alias(c) for c, kind in fields.items()],
    )


def merge_or_keep(existing: DataFrame, new: DataFrame) -> DataFrame:
    """``merge_batches`` if both sides have rows; else the side that has some."""
    if new.isEmpty():
        return existing
    if existing.isEmpty():
        return new
    return merge_batches(existing, new)


def enrich(listing: DataFrame, detail: DataFrame) -> DataFrame:
    """Fill the listing's empty fields from the detail record of the same code.

    ``detail`` has ``asin_key`` (upper case, unique).  A detail price never replaces a
    listing price, as a listing without price says "0".
    """
    fields = [f for f in schemas.DETAIL_SCHEMA if f.name in detail.columns]
    details = detail.where(F.col("asin_key") != "").select(
        "asin_key", *[F.col(f.name).alias(f"_d_{f.name}") for f in fields]
    )
    filled = {}
    for f in fields:
        found = F.when(has_value(F.col(f"_d_{f.name}"), f.dataType), F.col(f"_d_{f.name}"))
        if f.name in listing.columns:
            found = F.when(has_value(F.col(f.name), f.dataType), F.col(f.name)).otherwise(
                F.coalesce(found, F.col(f.name))
            )
        filled[f.name] = found
    return (
        listing.withColumn("asin_key", asin_key(F.col("asin")))
        .join(shuffled(details), "asin_key", "left")
        .withColumns(filled)
        .drop("asin_key", *[f"_d_{f.name}" for f in fields])
    )


def cache_records(enriched: DataFrame) -> DataFrame:
    """The cacheable part of enriched records: non-empty detail fields by code."""
    fields = [f for f in schemas.DETAIL_SCHEMA if f.name in enriched.columns]
    return enriched.select(
        asin_key(F.col("asin")).alias("asin_key"), "seq",
        *[F.when(has_value(F.col(f.name), f.dataType), F.col(f.name)).alias(f.name) for f in fields],
    ).where(F.col("asin_key") != "")


def update_cache(cache: DataFrame, enriched: DataFrame) -> DataFrame:
    """One record per code: the newest enriched one, else the cached one."""
    return newest_records(cache, cache_records(enriched))


def newest_records(cache: DataFrame, records: DataFrame) -> DataFrame:
    """``update_cache`` for records that ``cache_records`` made."""
    new = records.withColumn("_side", F.lit(1))
    old = cache.withColumn("_side", F.lit(0))
    both = old.unionByName(new, allowMissingColumns=True)
    return keep_one(both, "asin_key", [F.col("_side").desc(), F.col("seq").desc()]).drop("_side", "seq")


def detail_worklist(listing: DataFrame, cache: DataFrame, limit: int = 0) -> DataFrame:
    """Codes still without details, in listing order, at most ``limit`` (0: all).

    Cache rows without code match nothing and are left out of the join: a cache of such rows
    alone would have no key to join by and be compared with every code.
    """
    first = (
        listing.select(asin_key(F.col("asin")).alias("asin_key"), "seq")
        .where(F.col("asin_key") != "")
        .groupBy("asin_key").agg(F.min("seq").alias("seq"))
    )
    known = cache.select("asin_key").where(F.col("asin_key") != "")
    todo = first.join(shuffled(known), "asin_key", "left_anti")
    return todo.orderBy("seq", "asin_key").limit(limit) if limit > 0 else todo

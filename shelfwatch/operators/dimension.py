"""Product dimension: upsert, ids, backfill, sweep, evolution."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch import schemas
from shelfwatch.functions import classify, fixed as K, text
from shelfwatch.session import dealt, kept, shuffled
from shelfwatch.operators.clean import dedup_last, ensure_columns


# Raise it when the rules of ``backfill`` or ``sweep_dim`` change: all products are then due again.
RULES_VERSION = 1


def stamp(at: datetime) -> Column:
    return F.lit(at).cast("timestamp_ntz")


def with_load_defaults(clean: DataFrame) -> DataFrame:
    """Optional columns added; texts trimmed, blanks replaced; currency set."""
    full = ensure_columns(clean, schemas.CLEAN_SCHEMA)
    currency = F.col("currency") if "currency" in clean.columns else F.lit(None).cast("string")
    return full.withColumns(
        {
            **{c: text.load_text(F.col(c)) for c in schemas.CLEAN_TEXTS},
            "sku": F.col("sku").cast("string"),
            "currency": F.coalesce(currency, F.lit(K.CURRENCY)),
        }
    )


def assign_ids(rows: DataFrame, key: str, start: Column | int, name: str) -> DataFrame:
    """Dense ids ``start + 1 ...`` over rows with a unique ``key``, in its order; rows without key are left out.

    Numbering all rows in one window would pull them into one task.  The keys alone are
    dealt by range to partitions that Spark sizes by their data, sorted and written with
    their place; the partitions' counts add up to offsets; and the ids are joined to the
    rows.  The result depends on the keys alone.  ``rows`` is read twice: hand in a
    written table or a cheap plan.
    """
    keys = rows.select(key).where(F.col(key).isNotNull()).repartitionByRange(F.col(key)).sortWithinPartitions(key)
    placed = kept(keys.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn(
        "_part", F.shiftright("_at", 33)
    )
    # One row for each partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy("_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_first")).alias("_shift"))
    )
    start_at = start if isinstance(start, Column) else F.lit(start)
    ids = placed.join(parts, "_part").select(key, (start_at + F.col("_at") + F.col("_shift")).cast("long").alias(name))
    return rows.join(shuffled(ids), key)


def latest_rows(stage: DataFrame) -> DataFrame:
    """The last row per sku of a stage with ``seq``: key and attributes."""
    return dedup_last(stage.select("sku", "seq", *schemas.DIM_ATTRIBUTES)).drop("seq")


def upsert(dim: DataFrame, stage: DataFrame, at: datetime, last_id: Column | int | None = None) -> DataFrame:
    """Known skus get the stage's attributes, new skus a new id, others stay.

    ``stage`` carries ``seq``; of several rows per sku the last one counts.
    """
    return upsert_latest(dim, kept(latest_rows(stage), "latest"), at, last_id)


def upsert_latest(
    dim: DataFrame, incoming: DataFrame, at: datetime, last_id: Column | int | None = None
) -> DataFrame:
    """``upsert`` for rows that are unique by sku; ``incoming`` has the columns that it sets.

    They are read several times (known skus, new skus, their ids, the update), so a load
    hands in a written table rather than a plan.
    """
    attributes = [c for c in incoming.columns if c != "sku"]
    if last_id is None:
        last_id = dim.agg(F.coalesce(F.max("product_id"), F.lit(0)).alias("m")).scalar()
    # Skus of the batch that exist already; no larger than the batch.
    known = dim.select("sku").join(shuffled(incoming.select("sku")), "sku", "left_semi")
    new = assign_ids(incoming.join(shuffled(known), "sku", "left_anti"), "sku", last_id, "product_id")
    news = new.withColumns({"created_at": stamp(at), "updated_at": stamp(at)})
    fresh = incoming.select("sku", *[F.col(c).alias(f"_{c}") for c in attributes], F.lit(True).alias("_hit"))
    updated = dim.join(shuffled(fresh), "sku", "left").withColumns(
        {
            **{c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in attributes},
            "updated_at": F.when(F.col("_hit"), stamp(at)).otherwise(F.col("updated_at")),
        }
    )
    return updated.select(*dim.columns).unionByName(news.select(*dim.columns))


def backfill(dim: DataFrame, at: datetime) -> DataFrame:
    """Brand, device type and name recomputed for rows that need it.

    Narrow: one projection, no shuffle.  ``needs_refresh`` marks the changed rows.
    """
    title, brand = F.col("title"), F.col("brand")
    none = F.lit(None).cast("string")
    device = classify.corrected_device(title, none, F.col("device_type"))
    checked = dealt(dim).withColumn("_device", device).withColumn(
        "_brand",
        F.coalesce(classify.corrected_brand(title, brand, none, F.col("_device")), F.lit(K.PLACEHOLDER)),
    ).withColumn("_device", F.coalesce("_device", F.lit(K.PLACEHOLDER)))
    needs = (
        text.needs_new_name(F.col("product_name"))
        | ~brand.eqNullSafe(F.col("_brand"))
        | ~F.col("device_type").eqNullSafe(F.col("_device"))
    )
    new_name = F.coalesce(
        text.product_name(title), F.nullif(F.col("product_name"), F.lit("")), F.lit(K.PLACEHOLDER)
    )
    changed = F.col("needs_refresh")
    return (
        checked.withColumn("needs_refresh", needs)
        .withColumns(
            {
                "product_name": F.when(changed, new_name).otherwise(F.col("product_name")),
                "brand": F.when(changed, F.col("_brand")).otherwise(brand),
                "device_type": F.when(changed, F.col("_device")).otherwise(F.col("device_type")),
                **(
                    {"updated_at": F.when(changed, stamp(at)).otherwise(F.col("updated_at"))}
                    if "updated_at" in dim.columns else {}
                ),
            }
        )
        .drop("_brand", "_device")
    )


def sweep_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null, blank and marker texts become the placeholder, all columns in one pass."""
    def swept(c: str) -> Column:
        bare = F.lower(F.trim(c))
        missing = F.coalesce((bare == "") | bare.isin(*K.SWEEP_MISSING), F.lit(True))
        return F.when(missing, F.lit(K.PLACEHOLDER)).otherwise(F.col(c))

    changes = {c: swept(c) for c in columns if c in df.columns}
    if "currency" in df.columns:
        blank = F.coalesce(F.trim("currency") == "", F.lit(True))
        changes["currency"] = F.when(blank, F.lit(K.CURRENCY)).otherwise(F.col("currency"))
    return df.withColumns(changes)


def sweep_dim(dim: DataFrame) -> DataFrame:
    return sweep_missing(dim, schemas.DIM_ATTRIBUTES)


def evolve(df: DataFrame, target: T.StructType) -> DataFrame:
    """Old table shape to the target: columns added, cast, ordered; retired ones go."""
    full = ensure_columns(df, target)
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])


def evolve_dim(dim: DataFrame) -> DataFrame:
    """As ``evolve``; a missing device type takes the brand, as old rows kept it there."""
    return evolve(dim, schemas.DIM_SCHEMA).withColumn(
        "device_type", F.coalesce("device_type", "brand")
    )

"""Snapshot facts: append and sweeps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions import fixed as K, text
from shelfwatch.operators.dimension import assign_ids, evolve, stamp, sweep_missing
from shelfwatch.session import kept, shuffled


def append_facts(
    stage: DataFrame, dim: DataFrame, at: datetime, batch_id: int, last_id: Column | int = 0
) -> DataFrame:
    """One snapshot per stage row (also for repeated skus), dated by the batch.

    Both sides are joined on sku, with nothing but ``seq`` on the stage's side; the dimension
    is unique by sku, so a sku that holds a large part of the stage only makes the stage side
    long, which adaptive execution splits.  The wide rows are joined once, by ``seq``, with
    product and id.  ``stage`` is read twice: a load hands in a written table.
    """
    found = kept(stage.select("seq", "sku").join(shuffled(dim.select("sku", "product_id")), "sku").select("seq", "product_id"), "placed")
    numbered = stage.join(shuffled(assign_ids(found, "seq", last_id, "snapshot_id")), "seq")
    return evolve(
        numbered.withColumns(
            {
                "snapshot_timestamp": stamp(at),
                "snapshot_date": stamp(at).cast("date"),
                "batch_id": F.lit(batch_id).cast("long"),
            }
        ),
        schemas.FACT_SCHEMA,
    )


def sweep_facts(fact: DataFrame) -> DataFrame:
    """Missing texts and currency replaced; shipping terms taken out of the status."""
    return sweep_availability(sweep_missing(fact, schemas.FACT_TEXTS))


def sweep_availability(fact: DataFrame) -> DataFrame:
    status = F.col("availability")
    return fact.withColumn(
        "availability",
        F.when(text.mentions_shipping(status), F.lit(K.PLACEHOLDER)).otherwise(status),
    )


def evolve_fact(fact: DataFrame) -> DataFrame:
    return evolve(fact, schemas.FACT_SCHEMA)

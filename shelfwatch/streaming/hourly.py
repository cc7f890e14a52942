"""Incremental loading: each micro-batch of landed raw records is merged into all earlier ones and loaded."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwatch import schemas
from shelfwatch.operators import quality
from shelfwatch.operators.clean import ensure_columns, transform
from shelfwatch.session import prepare, work_folder
from shelfwatch.sources import store
from shelfwatch.sources.rawstate import RawState
from shelfwatch.sources.warehouse import Warehouse


def batch_loader(
    root: str,
    shape: Callable[[DataFrame], DataFrame],
    clock: Callable[[DataFrame], datetime],
    min_rows: int = 0,
    writer: Callable[[SparkSession], str] = lambda _: "stream",
) -> Callable[[DataFrame, int], None]:
    """The work of one micro-batch: merge it into the raw products, transform them all, check, load.

    So a product that a landing does not have gets a snapshot with the last values that are
    known of it.  Micro-batches are delivered at least once.  The batch id is the stream's
    epoch in the stream's own count of batches (``writer``), so a repeated delivery merges the same
    records again, replaces its own facts, and no others, and upserts the same products.
    """
    def load(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        kept = work_folder(spark, f"batch-{epoch}")
        at = clock(batch)
        # The clean batch is checked while it is written.
        landed = ensure_columns(shape(batch), schemas.RAW_SCHEMA)
        raw = RawState(spark, f"{root}/raw", landed.schema["seq"].dataType).land(landed, writer(spark), epoch)
        quality.gate(quality.summarize(quality.checked_write(transform(raw), kept, min_rows)))
        Warehouse(spark, root).load(spark.read.parquet(kept), at, batch_id=epoch + 1, writer=writer(spark))

    return load


def run_incremental(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    root: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    clock: Callable[[DataFrame], datetime] = lambda df: datetime.now(timezone.utc).replace(tzinfo=None),
    fmt: str = "parquet",
) -> StreamingQuery:
    """Load everything that has landed since the last run as one load, then stop.

    However many files have landed, they are one micro-batch.  Scheduled hourly; the checkpoint
    makes sure one file is taken once, and a second run over the same checkpoint cannot be
    active at the same time.  ``root`` holds the warehouse and, below ``raw``, the raw products.
    """
    prepare(spark)

    def stream_id(session: SparkSession) -> str:
        # Spark names a stream when its checkpoint is made: a new checkpoint counts anew.
        return f"stream-{json.loads(store.get(session, f'{checkpoint}/metadata'))['id']}"

    query = (
        spark.readStream.schema(schema).format(fmt)
        .load(landing)
        .writeStream.foreachBatch(batch_loader(root, shape, clock, writer=stream_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query

"""Product warehouse: two partitioned Parquet tables.

    root/dim_products/bucket=K/                                          products by a hash of their sku
    root/fact_product_snapshots/writer=W/batch_id=B/snapshot_date=D/     snapshots
    root/loads/N.json, N.done                                            who loads, and which ids are taken

A load rewrites only the buckets that it touches and replaces its own batch, both by dynamic
partition overwrite: Spark writes aside and puts whole partitions in place when all tasks are
done.  Readers scan the two tables and nothing else, so a query's plan does not depend on the
number of loads.  Batch ids count for each writer alone; repeating a batch of a writer
replaces that batch's snapshots and no others.

The numbered records under ``loads`` are the warehouse's sequences: a load takes the next
number, and with it ranges of ids, before it writes.  Of two loads that take the same number one
fails, and a load does not start while another one runs.  A load that died is taken over by the
same batch at once, by others when its lease has run out.
"""

from __future__ import annotations

import json
import re
import time
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch import schemas
from shelfwatch.operators import dimension, facts
from shelfwatch.session import bucket_numbers, kept
from shelfwatch.sources import store

BUCKETS = 32
LEASE_SECONDS = 6 * 3600
START = {"load": 0, "last_product_id": 0, "last_snapshot_id": 0, "buckets": 0}
BATCH, ADOPTED = "batch", "adopted"
# Columns of the dimension's files besides the public ones.
RULES, BUCKET, WRITER = "rules", "bucket", "writer"
DIM_FILES = T.StructType([*schemas.DIM_SCHEMA, T.StructField(RULES, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
FACT_FILES = T.StructType([*schemas.FACT_SCHEMA, T.StructField(WRITER, T.StringType())])


class BusyError(RuntimeError):
    """Another load of this warehouse is running."""


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        """``buckets`` counts when the warehouse is made; later loads use its own number."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self._dim = f"{self.root}/dim_products"
        self._fact = f"{self.root}/fact_product_snapshots"

    # --- loads ---------------------------------------------------------------
    def head(self) -> dict:
        """The record of the newest load."""
        for name in reversed(store.names(self.spark, f"{self.root}/loads/*.json")):
            text = store.get(self.spark, f"{self.root}/loads/{name}")
            if text.endswith("\n"):  # else it is being written right now
                return json.loads(text)
        return dict(START)

    def _take(self, writer: str, batch: int, products: int, snapshots: int) -> tuple[dict, dict]:
        """(the record before, a new one that reserves so many ids)."""
        before = self.head()
        number = before["load"]
        if number and not store.exists(self.spark, f"{self.root}/loads/{number:010d}.done"):
            same = (before["writer"], before["batch"]) == (writer, batch)
            if not same and time.time() - before["taken_at"] < LEASE_SECONDS:
                raise BusyError(f"{self.root}: load {number} of {before['writer']} has not ended")
        record = {
            "load": number + 1, "writer": writer, "batch": batch, "taken_at": time.time(),
            "last_product_id": before["last_product_id"] + products,
            "last_snapshot_id": before["last_snapshot_id"] + snapshots,
            "buckets": before["buckets"] or self.buckets,
        }
        store.put(self.spark, f"{self.root}/loads/{number + 1:010d}.json", json.dumps(record) + "\n")
        return before, record

    def _ended(self, record: dict) -> dict:
        store.put(self.spark, f"{self.root}/loads/{record['load']:010d}.done", "\n")
        return record

    def create(self) -> None:
        """Empty tables, if there are none yet."""
        if self.head()["load"] == 0:
            _, record = self._take(BATCH, 0, 0, 0)
            self.spark.createDataFrame([], DIM_FILES).write.partitionBy(BUCKET).parquet(self._dim)
            self.spark.createDataFrame([], FACT_FILES).write.partitionBy(WRITER, "batch_id", "snapshot_date").parquet(self._fact)
            self._ended(record)

    # --- reading -------------------------------------------------------------
    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        if not store.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def dim(self) -> DataFrame:
        return self._read(self._dim, DIM_FILES).select(*schemas.DIM_SCHEMA.fieldNames())

    def fact(self) -> DataFrame:
        """All snapshots; filters on ``batch_id`` and ``snapshot_date`` prune partitions."""
        return self._read(self._fact, FACT_FILES).select(*schemas.FACT_SCHEMA.fieldNames())

    def batches(self) -> DataFrame:
        """(writer, batch_id, snapshots) of every batch that has snapshots."""
        return self._read(self._fact, FACT_FILES).groupBy(WRITER, "batch_id").agg(F.count(F.lit(1)).alias("snapshots"))

    def register(self) -> None:
        """Temp views for SQL users."""
        self.dim().createOrReplaceTempView("dim_products")
        self.fact().createOrReplaceTempView("fact_product_snapshots")

    # --- writing -------------------------------------------------------------
    def load(
        self, clean: DataFrame, at: datetime, batch_id: int | None = None, writer: str = BATCH
    ) -> dict:
        """Upsert the dimension and append one snapshot per row of a clean batch.

        ``clean`` carries ``seq``; rows without sku are left out.  Products that were loaded
        since the rules were last applied to them are brought up to date first (brand,
        device type, name, missing texts).  ``batch_id`` counts for ``writer`` alone; without
        one the writer's next id is taken.  Returns the load's record.
        """
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", writer):
            raise ValueError(f"writer names hold letters, digits, _, . and -: {writer!r}")
        batch = self._next_batch(writer) if batch_id is None else batch_id
        # Read several times below: computed once.
        stage = kept(dimension.with_load_defaults(clean.where(F.col("sku").isNotNull())), "stage")
        latest = kept(dimension.latest_rows(stage), "latest")
        before, record = self._take(writer, batch, latest.count(), stage.count())
        bucket = sku_bucket(record["buckets"])
        incoming = latest.withColumns({RULES: F.lit(None).cast("int"), BUCKET: bucket})
        products = self._read(self._dim, DIM_FILES)
        touched = bucket_numbers(incoming.select(BUCKET).unionByName(products.where(due()).select(BUCKET)))
        if touched:
            prior = products.where(F.col(BUCKET).isin(touched))
            current = prior.where(~due()).unionByName(maintained(prior.where(due()), at))
            merged = dimension.upsert_latest(current, incoming, at, before["last_product_id"])
            self._overwrite(merged.select(*DIM_FILES.fieldNames()).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "sku"), self._dim, BUCKET)
        now = self._read(self._dim, DIM_FILES).where(F.col(BUCKET).isin(touched)).select("sku", "product_id")
        new = facts.sweep_facts(facts.append_facts(stage, now, at, batch, before["last_snapshot_id"]))
        self._write_facts(new.withColumn(WRITER, F.lit(writer)))
        # Dates that an earlier run of this batch had and this one has not.
        here = f"{self._fact}/{WRITER}={writer}/batch_id={batch}"
        dates = {f"snapshot_date={at.date()}"} if record["last_snapshot_id"] > before["last_snapshot_id"] else set()
        for name in set(store.names(self.spark, f"{here}/snapshot_date=*")) - dates:
            store.remove(self.spark, f"{here}/{name}")
        return self._ended(record)

    def adopt(self, dim: DataFrame, fact: DataFrame, batch_id: int = 0) -> dict:
        """Take over tables of an older shape: evolve, fill in, sweep.

        Facts keep their batch ids, as batches of a writer of their own.
        """
        if self.head()["load"]:
            raise ValueError("only an empty warehouse can take over tables")
        moved = dimension.sweep_dim(dimension.evolve_dim(dim))
        old = facts.sweep_facts(facts.evolve_fact(fact)).withColumn(
            "batch_id", F.coalesce("batch_id", F.lit(batch_id).cast("long"))
        )
        largest = [df.agg(F.max(c)).first()[0] or 0 for df, c in ((moved, "product_id"), (old, "snapshot_id"))]
        _, record = self._take(ADOPTED, batch_id, *largest)
        files = moved.withColumns({RULES: F.lit(None).cast("int"), BUCKET: sku_bucket(record["buckets"])})
        self._overwrite(files.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "sku"), self._dim, BUCKET)
        self._write_facts(old.withColumn(WRITER, F.lit(ADOPTED)))
        return self._ended(record)

    def _next_batch(self, writer: str) -> int:
        known = store.names(self.spark, f"{self._fact}/{WRITER}={writer}/batch_id=*")
        return max((int(n.split("=")[1]) for n in known), default=0) + 1

    def _write_facts(self, new: DataFrame) -> None:
        keys = (WRITER, "batch_id", "snapshot_date")
        self._overwrite(new.sortWithinPartitions(*keys, "product_id"), self._fact, *keys)

    def _overwrite(self, df: DataFrame, path: str, *keys: str) -> None:
        """Replace the partitions that ``df`` has rows for."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def sku_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("sku"), F.lit(buckets)).cast("int")


def due() -> Column:
    """Products that the present rules have not been applied to."""
    return F.coalesce(F.col(RULES) != dimension.RULES_VERSION, F.lit(True))


def maintained(products: DataFrame, at: datetime) -> DataFrame:
    """Brand, device type, name and missing texts by the present rules."""
    shaped = products.withColumn("device_type", F.coalesce("device_type", "brand"))
    swept = dimension.sweep_dim(dimension.backfill(shaped, at).drop("needs_refresh"))
    return swept.withColumn(RULES, F.lit(dimension.RULES_VERSION)).select(*products.columns)

"""All raw records that have landed so far, merged by product: a table kept up to date landing by landing.

    root/products/bucket=K/     one row per product (by a hash of its identity): last non-empty values
    root/landings/N.json        who landed

A landing rewrites only the buckets that it has products in, by dynamic partition overwrite.
Taking the same landing again gives the same table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch import schemas
from shelfwatch.operators import merge
from shelfwatch.session import bucket_numbers, kept
from shelfwatch.sources import store

BUCKETS = 32


class RawState:
    def __init__(self, spark: SparkSession, root: str, seq: T.DataType, buckets: int = BUCKETS) -> None:
        """``seq``: the type of the landings' order; ``buckets`` stays as it was when the table was made."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.path = f"{self.root}/products"
        self.buckets = buckets
        self.schema = T.StructType([
            T.StructField("identity", T.StringType()), T.StructField("landing", T.LongType()),
            T.StructField("seq", seq), *schemas.RAW_SCHEMA, T.StructField("bucket", T.IntegerType()),
        ])

    def products(self) -> DataFrame:
        """identity, landing and seq (both of the first appearance), fields, bucket."""
        if not store.exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _number(self, writer: str, batch: int) -> tuple[int, int]:
        """The landing's number, the same one if it is taken again, and the number of buckets."""
        known = store.names(self.spark, f"{self.root}/landings/*.json")
        for name in reversed(known):
            text = store.get(self.spark, f"{self.root}/landings/{name}")
            if text.endswith("\n"):  # else its writer died while it wrote
                last = json.loads(text)
                if (last["writer"], last["batch"]) == (writer, batch):
                    return last["landing"], last["buckets"]
                break
        else:
            last = {"buckets": self.buckets}
        number = int(known[-1].split(".")[0]) + 1 if known else 1
        record = {"landing": number, "writer": writer, "batch": batch, "buckets": last["buckets"]}
        store.put(self.spark, f"{self.root}/landings/{number:010d}.json", json.dumps(record) + "\n")
        return number, last["buckets"]

    def land(self, rows: DataFrame, writer: str, batch: int) -> DataFrame:
        """Merge a landing (raw records with ``seq``) into the table; the raw records to transform next.

        The first landing is handed on as it is, later ones as the merged products, ordered by
        their first appearance.  An empty landing changes nothing: the products so far are
        handed on.
        """
        number, buckets = self._number(writer, batch)
        rows = kept(rows.select("seq", *schemas.RAW_SCHEMA.fieldNames()), "landed")
        new = merge.merged_rows(rows, number).withColumn("bucket", F.pmod(F.xxhash64("identity"), F.lit(buckets)).cast("int"))
        new = kept(new, "landed")
        touched = bucket_numbers(new)
        if touched:
            merged = merge.into_products(self.products().where(F.col("bucket").isin(touched)), new)
            (
                merged.select(*self.schema.fieldNames()).hint("rebalance", "bucket").sortWithinPartitions("bucket", "identity")
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)
            )
        if touched and self.products().where(F.col("landing") < number).isEmpty():
            return rows
        return self.products().select(F.struct("landing", "seq").alias("seq"), *schemas.RAW_SCHEMA.fieldNames())

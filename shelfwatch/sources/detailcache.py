"""Product details kept over runs: one record per product code, in buckets by a hash of the code.

A run reads and rewrites only the buckets of the codes that it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch import schemas
from shelfwatch.operators import merge
from shelfwatch.session import bucket_numbers, kept
from shelfwatch.sources import store

BUCKETS = 32


class DetailCache:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        """``buckets`` stays as it was when the cache was made."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.schema = T.StructType([
            T.StructField("asin_key", T.StringType()), *schemas.DETAIL_SCHEMA, T.StructField("bucket", T.IntegerType()),
        ])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("asin_key"), F.lit(self.buckets)).cast("int")

    def records(self, codes: DataFrame | None = None) -> DataFrame:
        """The cached records; given codes (``asin_key``), of their buckets only."""
        if not store.exists(self.spark, self.path):
            found = self.spark.createDataFrame([], self.schema)
        else:
            found = self.spark.read.schema(self.schema).parquet(self.path)
        if codes is not None:
            found = found.where(F.col("bucket").isin(bucket_numbers(codes.select(self._bucket().alias("bucket")))))
        return found.drop("bucket")

    def update(self, enriched: DataFrame) -> None:
        """Keep the detail fields of enriched records (``asin``, ``seq``), newest record of each code."""
        new = kept(merge.cache_records(enriched), "details")
        if new.isEmpty():
            return
        records = merge.newest_records(self.records(new), new).withColumn("bucket", self._bucket())
        (
            records.select(*self.schema.fieldNames()).hint("rebalance", "bucket").sortWithinPartitions("bucket", "asin_key")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)
        )

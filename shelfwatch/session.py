"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
PARTITIONS_SETTING = "spark.shelfwatch.inputPartitions"

# Settings results rely on: one time zone, and the last of two equal map keys wins.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}
# Adaptive execution resizes partitions, splits skewed joins and picks broadcast
# joins from measured sizes, so no partition count or join hint is fixed in code.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(
    cores: int | str = "*", memory: str = "8g", partitions: int = 8, shared: str | None = None
) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfwatch")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if str(cores).isdigit():
        # The test tables are single files, which a scan cannot split.
        builder = builder.config(PARTITIONS_SETTING, str(cores))
    if shared:
        builder = builder.config(CHECKPOINT_SETTING, shared)
    for key, value in {**REQUIRED, **ADAPTIVE}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results rely on; leave tuning to the cluster."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables, where the driver and all executors see it.

    It lies in the shared folder named by ``spark.checkpoint.dir`` or, where that is unset,
    below the session's warehouse folder, which executors share as well.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{shared.rstrip('/')}/shelfwatch/{purpose}-{uuid.uuid4().hex}"


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that is read several times to the shared folder and read it back.

    It is computed once and survives lost executors.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_numbers(df: DataFrame, column: str = "bucket") -> list[int]:
    """The different bucket numbers of a table: at most as many as there are buckets, in one row."""
    return df.agg(F.array_sort(F.collect_set(column))).first()[0]


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: joined by shuffle, never sent to all through the driver.

    Spark plans a join with a written table by the size of its files, which codes in order pack to
    a small part of what they take in memory.
    """
    return df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """Narrow rows dealt evenly to as many tasks as shuffles have, before each becomes a wide or costly one.

    A scan splits its input by bytes, whatever is made of a row: a small file would be one task.
    """
    conf = df.sparkSession.conf
    return df.repartition(int(conf.get(PARTITIONS_SETTING, None) or conf.get("spark.sql.shuffle.partitions")))


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt to as many tasks as the caller asks for, before costly work on each row.

    The caller's setting ``spark.shelfwatch.inputPartitions`` holds the number.  Unset, as
    on a cluster, scans split their input and nothing moves.
    """
    count = df.sparkSession.conf.get(PARTITIONS_SETTING, None)
    return df.repartition(int(count)) if count else df

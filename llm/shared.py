"""Shared folders, written intermediate tables, vectors and row keys."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's shared folder; the session must name one."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{root.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str) -> list[Column]:
    """128 bits that stand for the columns' values, nulls included."""
    cols = [F.col(c) for c in columns]
    return [F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit(7), *reversed(cols)).alias("k2")]


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows that hold a usable vector, their values in double precision).

    Null, zero, empty, ragged and non-finite vectors are left out.  The usual width is
    that of most rows.
    """
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    if not len(lengths) or not lengths.any():
        return np.zeros(0, np.int64), np.zeros((0, 1))
    width = np.bincount(lengths[lengths > 0]).argmax()
    good = np.flatnonzero(lengths == width)
    flat = pc.list_flatten(column.take(pa.array(good)))
    values = np.asarray(pc.fill_null(flat.cast(pa.float64()), float("nan"))).reshape(-1, width)
    fine = np.isfinite(values).all(axis=1) & (values != 0).any(axis=1)
    return good[fine], values[fine]

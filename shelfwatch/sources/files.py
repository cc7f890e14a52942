"""File sources and sinks.

Paths may lie on any file system Spark can reach.  Replacing sinks write a new
directory and then name it in a marker, so readers see the old or the new data, never
a part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch import schemas
from shelfwatch.session import kept
from shelfwatch.sources import store


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """JSON files, each an array of product objects, with ``seq`` (file, position).

    A missing path, and a file that is unreadable or no array, count as empty.  Keys
    outside the schema are ignored, absent ones are null.  Files are read in parts, however
    large one is: see ``json_records``.
    """
    if not store.exists(spark, path):
        return spark.createDataFrame(
            [], T.StructType([T.StructField("seq", SEQ_TYPE), *schemas.RAW_SCHEMA.fields])
        )
    records, plain = json_records(spark, path)
    shape = T.StructType([*schemas.RAW_SCHEMA.fields, T.StructField("_bad", T.StringType())])
    parsed = kept(
        records.select("file", "position", F.from_json("value", shape, {"columnNameOfCorruptRecord": "_bad"}).alias("item")),
        "records",
    )
    # One row for each file.
    whole = plain.join(parsed.where("item._bad IS NOT NULL").select("file").distinct(), "file", "left_anti")
    found = parsed.join(whole, "file", "left_semi").select(
        F.struct("file", F.col("position").cast("int").alias("position")).alias("seq"), *[f"item.{f.name}" for f in schemas.RAW_SCHEMA]
    )
    return found.unionByName(_whole_arrays(spark, path, plain))


def _whole_arrays(spark: SparkSession, path: str, plain: DataFrame) -> DataFrame:
    """Files that are not plain arrays of objects, each read by one task: items of other kinds, or no array at all."""
    files = spark.read.option("wholetext", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.btrim("value", F.lit(" \t\r\n")).alias("value")
    ).join(plain, "file", "left_anti")
    items = F.from_json("value", T.ArrayType(schemas.RAW_SCHEMA))
    return (
        files.where(F.col("value").startswith("[") & F.col("value").endswith("]"))
        .select("file", F.posexplode(items).alias("position", "item"))
        .where(F.col("item").isNotNull())
        .select(F.struct("file", "position").alias("seq"), "item.*")
    )


def json_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, files): the objects of JSON arrays as text, and the files that are plain arrays of objects.

    Text is split at closing braces, which Spark does within byte ranges of a file, so one
    large array is read by many tasks.  A piece changes the state of the reader, which is
    whether a string is open and how many objects are: the first by the parity of its quotes,
    the second by its braces outside of strings, counted for both states it may begin in.  Pieces
    add up within a range and ranges within a file, which gives every piece its state; a record
    ends where the last open object closes.
    """
    pieces = kept(
        spark.read.option("lineSep", "}").text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
            F.monotonically_increasing_id().alias("at"), "value",
        ), "pieces",
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")

    def count(text: Column, char: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))

    def outside(text: Column) -> Column:
        return F.regexp_replace(text, r'(?s)"[^"]*("|\z)', "")

    def opened(text: Column, open_at_end: Column) -> Column:
        # The brace that ends the piece closes an object unless it stands in a string.
        return count(text, "{") - F.when(open_at_end, 0).otherwise(1)

    odd = count(bare, '"') % 2
    inside = outside(F.regexp_replace(bare, r'(?s)\A[^"]*("|\z)', ""))
    local = pieces.select(
        "file", "range", "at", odd.alias("odd"), opened(outside(bare), odd == 1).alias("from_closed"), opened(inside, odd == 0).alias("from_open"),
    )
    # Within a range: a range is as long as a task's input, whatever the file's size.
    ahead = Window.partitionBy("file", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = kept(local.withColumn("flips", F.coalesce(F.sum("odd").over(ahead), F.lit(0)) % 2), "states")

    def depth_from(state: Column) -> Column:
        return F.when((F.col("flips") + state) % 2 == 0, F.col("from_closed")).otherwise(F.col("from_open"))

    # One row for each range.
    ranges = local.groupBy("file", "range").agg(
        (F.sum("odd") % 2).alias("odd"), F.sum(depth_from(F.lit(0))).alias("d0"), F.sum(depth_from(F.lit(1))).alias("d1"),
        F.max("at").alias("last"),
    )
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("state", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    ranges = ranges.withColumn("depth", F.coalesce(F.sum(F.when(F.col("state") == 0, F.col("d0")).otherwise(F.col("d1"))).over(before), F.lit(0)))
    ranges = ranges.withColumn("tail", F.max("last").over(Window.partitionBy("file")))
    upto = Window.partitionBy("file", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = local.join(ranges.select("file", "range", "state", "depth", "tail"), ["file", "range"]).withColumn(
        "deep", F.col("depth") + F.sum(depth_from(F.col("state"))).over(upto)
    )
    open_at_end = (F.col("flips") + F.col("state") + F.col("odd")) % 2 == 1
    ends = ((F.col("deep") == 0) & ~open_at_end & (F.col("at") < F.col("tail"))).cast("long")
    placed = kept(placed.select("file", "range", "at", "tail", ends.alias("ends"), F.coalesce(F.sum(ends).over(ahead), F.lit(0)).alias("nth")), "places")
    totals = placed.groupBy("file", "range").agg(F.sum("ends").alias("ended"))
    totals = totals.select("file", "range", F.coalesce(F.sum("ended").over(before), F.lit(0)).alias("earlier"))
    numbered = (
        pieces.join(placed.select("at", "range", "file", "tail", "nth"), ["file", "range", "at"]).join(totals, ["file", "range"])
        .select("file", (F.col("earlier") + F.col("nth")).alias("position"), "at", (F.col("at") == F.col("tail")).alias("is_tail"), "value")
    )
    # A record's pieces: as many as it has objects in it.
    record = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda p: p["value"]), "}"), F.lit("}"))
    records = kept(
        numbered.where(~F.col("is_tail")).groupBy("file", "position").agg(record.alias("value"))
        .withColumn("lead", F.regexp_extract("value", r"(?s)\A[^{]*", 0)), "arrays",
    )
    first = F.col("position") == 0
    plain_lead = F.when(first, F.col("lead").rlike(r"\A\s*\[\s*\z")).otherwise(F.col("lead").rlike(r"\A\s*,\s*\z"))
    odd_files = records.where(~plain_lead).select("file").unionByName(
        numbered.where(F.col("is_tail") & ~F.col("value").rlike(r"\A\s*\]\s*\z")).select("file")
    )
    files = kept(pieces.select("file").distinct().join(odd_files.distinct(), "file", "left_anti"), "files")
    return records.select("file", "position", F.substr("value", F.length("lead") + 1).alias("value")), files


SEQ_TYPE = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("position", T.IntegerType())]
)


SPACES_STAY = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Clean CSV by column name with fixed types: an all-digit sku keeps its zeros, "N/A" stays text.

    Quoted values may hold line breaks.  Only the columns that the file has come back, so
    that the quality report can name the missing ones.
    """
    text = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        .options(**SPACES_STAY).csv(path)
    )
    kinds = {schemas.EDGE_NAMES.get(f.name, f.name): f for f in schemas.CLEAN_SCHEMA}
    return text.select(
        *[F.expr(f"try_cast(`{c}` AS {kinds[c].dataType.simpleString()})").alias(kinds[c].name) for c in text.columns if c in kinds]
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page table (page_id, url, html and, if there is one, category)."""
    return spark.read.parquet(path)


def _edge_names(df: DataFrame) -> list[Column]:
    return [F.col(c).alias(schemas.EDGE_NAMES.get(c, c)) for c in df.columns]


def write_raw(df: DataFrame, path: str) -> str:
    """Replace a raw data set as a whole; returns the directory written."""
    target = f"{path}/data-{uuid.uuid4().hex}"
    df.write.json(target)
    # Pointers are numbered and never changed: readers take the newest complete one.
    number = published(df.sparkSession, path) + 1
    store.put(df.sparkSession, f"{path}/current-{number:010d}", f"{target}\n")
    return target


def published(spark: SparkSession, path: str) -> int:
    """How often ``write_raw`` has published."""
    known = store.names(spark, f"{path}/current-*")
    return int(known[-1].split("-")[1]) if known else 0


def read_raw_current(spark: SparkSession, path: str, seq: str = "seq long") -> DataFrame:
    """What ``write_raw`` last published (with its ``seq``)."""
    schema = T.StructType(
        [*T.StructType.fromDDL(seq).fields, *schemas.RAW_SCHEMA.fields]
    )
    for name in reversed(store.names(spark, f"{path}/current-*")):
        target = store.get(spark, f"{path}/{name}")
        if target.endswith("\n"):  # else it is being written right now
            return spark.read.schema(schema).json(target.strip())
    return spark.createDataFrame([], schema)


def write_clean(clean: DataFrame, path: str) -> None:
    """Clean batch as CSV under the edge names; an empty batch keeps its header."""
    shaped = clean.select(*schemas.CLEAN_COLUMNS)
    shaped.select(*_edge_names(shaped)).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).options(**SPACES_STAY).csv(path)


def clean_path(raw_path: str) -> str:
    """Output name of a raw input: raw_x.json -> clean_x.csv."""
    return raw_path.replace("raw_", "clean_").replace(".json", ".csv")


def write_report(report: DataFrame, path: str) -> None:
    """Quality report as JSON (call it before the gate, so failures are on record)."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_profiles(profiles: dict[str, DataFrame], folder: str) -> None:
    """Profile tables as CSV, one directory each."""
    for name, df in profiles.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")

"""The batch job: raw to clean, check, load into every warehouse, check freshness."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.functions import fixed as K
from shelfwatch.operators import merge, quality, reports
from shelfwatch.operators.clean import transform
from shelfwatch.functions.urls import asin_key
from shelfwatch.session import kept, prepare, shuffled
from shelfwatch.sources import files, pages as page_source
from shelfwatch.sources.detailcache import DetailCache
from shelfwatch.sources.warehouse import Warehouse

FULL, SKIP_EXTRACT, LOAD_ONLY = "full", "skip-extract", "load-only"


@dataclass(frozen=True)
class BatchConfig:
    """Where things are.  ``pages`` is needed in full mode only."""

    data_dir: str
    warehouses: tuple[str, ...]
    pages: str | None = None
    detail_pages: str | None = None
    raw_name: str = "raw_products"
    max_details: int = 0  # products whose details are looked up in one run; 0: all
    min_rows: int = 1
    max_age_hours: float = K.MAX_AGE_HOURS

    @property
    def raw(self) -> str:
        return f"{self.data_dir}/{self.raw_name}"

    @property
    def detail_cache(self) -> str:
        return f"{self.data_dir}/detail_cache"

    @property
    def clean(self) -> str:
        return files.clean_path(self.raw)

    @property
    def report(self) -> str:
        return f"{self.data_dir}/data_quality_report"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class StaleError(ValueError):
    """A warehouse has no snapshots, or none that is recent enough."""


def extract(spark: SparkSession, cfg: BatchConfig) -> DataFrame:
    """Pages to raw records, enriched and merged with the earlier raw data."""
    listing = page_source.extract_listings(files.read_pages(spark, cfg.pages)).withColumn(
        "seq", F.struct("page_id", "position")
    )
    if cfg.detail_pages:
        listing = with_details(spark, cfg, kept(listing, "listing"))
    earlier = files.read_raw_current(spark, cfg.raw, RAW_SEQ)
    # Runs are numbered, so that records of two runs never share a place.
    number = files.published(spark, cfg.raw) + 1
    new = listing.withColumn(
        "seq", F.struct(F.lit(number).alias("batch"), F.col("seq.page_id"), F.col("seq.position"))
    ).drop("page_id", "position")
    # Parsed once: the merge asks whether there are rows before it reads them.
    merged = merge.merge_or_keep(earlier, kept(new, "extracted"))
    files.write_raw(merged.drop("identity", "batch"), cfg.raw)
    return files.read_raw_current(spark, cfg.raw, RAW_SEQ)


def with_details(spark: SparkSession, cfg: BatchConfig, listing: DataFrame) -> DataFrame:
    """Listing records filled from the detail cache, which first learns the codes that it lacks.

    Only detail pages of codes on the work-list are parsed: those that are not cached, in
    listing order, up to ``max_details``.  A page's code is taken from its link; pages whose link has
    none are parsed to see.  Cached products are filled whatever the work-list's cap.
    """
    cache = DetailCache(spark, cfg.detail_cache)
    codes = listing.select(asin_key(F.col("asin")).alias("asin_key"))
    todo = kept(merge.detail_worklist(listing, cache.records(codes), cfg.max_details).select("asin_key"), "todo")
    if not todo.isEmpty():
        side = (lambda df: df) if cfg.max_details > 0 else shuffled  # a capped work-list stays small
        pages = files.read_pages(spark, cfg.detail_pages)
        linked = F.upper(F.regexp_extract(F.coalesce("url", F.lit("")), K.PAGE_CODE, 1))
        known = pages.where(linked != "").join(side(todo), linked == F.col("asin_key"), "left_semi")
        details = page_source.extract_details(known.unionByName(pages.where(linked == "")))
        code = F.coalesce(F.nullif(F.upper("page_code"), F.lit("")), F.upper(F.regexp_extract("url", K.PAGE_CODE, 1)))
        newest = details.select(code.alias("asin_key"), F.col("page_id").alias("seq"), *page_source.schemas.DETAIL_FIELDS)
        found = merge.keep_one(newest.join(side(todo), "asin_key", "left_semi"), "asin_key", [F.col("seq").desc()]).drop("seq")
        found = kept(found, "details")
        new = listing.join(side(found.select("asin_key")), asin_key(F.col("asin")) == F.col("asin_key"), "left_semi")
        cache.update(merge.enrich(new, found))
    return merge.enrich(listing, cache.records(codes))


def given_raw(spark: SparkSession, cfg: BatchConfig) -> DataFrame:
    """Raw records of an earlier run or, if there was none, the JSON arrays at the raw path."""
    if files.published(spark, cfg.raw):
        return files.read_raw_current(spark, cfg.raw, RAW_SEQ)
    return files.read_raw(spark, cfg.raw)


RAW_SEQ = "seq struct<batch: int, page_id: long, position: long>"


def check(report: DataFrame, cfg: BatchConfig) -> DataFrame:
    """Write the quality report, then raise if a rule is broken."""
    summary = quality.summarize(report)
    files.write_report(summary, cfg.report)
    quality.gate(report.sparkSession.read.schema(summary.schema).json(cfg.report))
    return summary


def check_freshness(wh: Warehouse, now: datetime, max_age_hours: float) -> None:
    row = reports.freshness(wh.fact(), now, max_age_hours).first()
    if row["latest_snapshot"] is None:
        raise StaleError(f"{wh.root}: no snapshots found")
    if not row["fresh"]:
        raise StaleError(f"{wh.root}: latest snapshot is {row['age_hours']:.2f} hours old")


def load_all(
    spark: SparkSession, clean: DataFrame, roots: Sequence[str], at: datetime,
    batch_id: int | None = None, max_age_hours: float = K.MAX_AGE_HOURS,
    now: Callable[[], datetime] = utc_now,
) -> list[dict]:
    """Load each warehouse (each commits by itself), then check all for freshness.

    The batch's id is its time, so a batch that is run again after one warehouse failed
    replaces what it loaded into the others.
    """
    run_id = int(at.replace(tzinfo=timezone.utc).timestamp() * 1_000_000) if batch_id is None else batch_id
    warehouses = [Warehouse(spark, root) for root in roots]
    commits = [wh.load(clean, at, run_id) for wh in warehouses]
    for wh in warehouses:
        check_freshness(wh, now(), max_age_hours)
    return commits


def run(
    spark: SparkSession, cfg: BatchConfig, mode: str, at: datetime, now: Callable[[], datetime] = utc_now
) -> list[dict]:
    """One batch in one of three modes; ``now`` is the clock that freshness is tested by.

    The clean batch is written once as Parquet, which also counts what the quality rules ask for,
    and read back by every load, so it is computed once even if executors are lost on the way.
    """
    prepare(spark)
    if mode not in (FULL, SKIP_EXTRACT, LOAD_ONLY):
        raise ValueError(f"unknown mode: {mode}")
    path = f"{cfg.clean}.parquet"
    if mode == LOAD_ONLY:
        clean = files.read_clean(spark, cfg.clean).withColumn("seq", F.monotonically_increasing_id())
    else:
        clean = transform(extract(spark, cfg) if mode == FULL else given_raw(spark, cfg))
    report = quality.checked_write(clean, path, cfg.min_rows)
    clean = spark.read.parquet(path)
    if mode != LOAD_ONLY:
        files.write_clean(clean, cfg.clean)
    check(report, cfg)
    return load_all(spark, clean, cfg.warehouses, at, max_age_hours=cfg.max_age_hours, now=now)

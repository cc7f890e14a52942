"""Registered queries: every operator over the whole of the given tables.

Each entry takes (spark, sf_dir) and returns a DataFrame.  Results are given in plain
types (long, double, string) so that they compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions import classify, numbers, text, urls
from shelfwatch.operators import clean, dimension, facts, measures, merge, profile, quality, reports
from shelfwatch.plans import batch, views
from shelfwatch.session import dealt, prepare, shuffled, work_folder
from shelfwatch.sources import files, pages
from shelfwatch.sources.warehouse import Warehouse
from shelfwatch.streaming.hourly import run_incremental

Query = Callable[[SparkSession, str], DataFrame]

# Fixed clocks: no query reads the wall clock.
NOW = datetime(2001, 11, 5, 7, 30, 0)
LOAD_TIME = datetime(2024, 1, 1, 12, 0, 0)
HIGH_DISCOUNT = 8
# The days that part the three landings; the first and the last are open, so no day is left out.
PERIODS = ("1997-01-01", "1999-01-01")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, whole numbers as longs, dates and times as text."""
    def shown(name: str, kind: str) -> Column:
        col = F.col(f"`{name}`")
        if kind.startswith("decimal") or kind == "float":
            return col.cast("double").alias(name)
        if kind in ("int", "smallint", "tinyint", "boolean"):
            return col.cast("long").alias(name)
        if kind == "date":
            return F.date_format(col, "yyyy-MM-dd").alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(name)
        return col

    return df.select(*[shown(n, k) for n, k in df.dtypes])


def cents_up(col: Column, places: int = 2) -> Column:
    """A double settled to ``places`` digits through a whole number."""
    factor = 10 ** places
    return F.round(col * factor).cast("long") / F.lit(float(factor))


# --- text and numbers ----------------------------------------------------------
def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(views.table(spark, sf_dir, "documents").select("doc_id", "text"))


def _text_query(**columns: Callable[[Column], Column]) -> Query:
    """Functions applied to the whole text of every document."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = F.col("text")
        return plain(_documents(spark, sf_dir).select(
            "doc_id", *[f(t).alias(name) for name, f in columns.items()]
        ))
    return run


def _raw_query(**columns: Column | Callable[[], Column]) -> Query:
    """Expressions over the raw records."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = views.full_raw(views.raw_records(spark, sf_dir))
        return plain(raw.select("seq", *[f().alias(name) for name, f in columns.items()]))
    return run


def discount_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.full_raw(views.raw_records(spark, sf_dir)).select(
        "seq", numbers.clean_price(F.col("price")).alias("price"),
        numbers.clean_price(F.col("original_price")).alias("original_price"), "discount_percent",
    )
    return raw.select(
        "seq",
        numbers.discount_percent(F.col("price"), F.col("original_price")).alias("discount"),
        numbers.final_discount(
            F.when(F.col("seq") % 7 == 0, F.lit("15%")), F.col("price"), F.col("original_price")
        ).alias("final_discount"),
        numbers.currency(F.col("price"), F.col("original_price")).alias("currency"),
    )


# --- clean -----------------------------------------------------------------------
def clean_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.transform(views.raw_records(spark, sf_dir))


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_records(spark, sf_dir).select("seq", F.col("product_url").alias("sku"), "title", "price")
    return clean.dedup_first(raw)


def dedup_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First document of each text (compared trimmed and lower-cased)."""
    docs = views.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"), F.lower(text.strip(F.col("text"))).alias("sku"), "source"
    )
    return clean.dedup_first(docs).select("seq", "source")


def repair_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = clean.with_required(views.clean_batch(spark, sf_dir))
    fixed = batch.transform(clean.fill_defaults).transform(clean.repair_prices)
    return plain(
        fixed.groupBy("sku").agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.sum(F.round(F.col(c) * 100).cast("long")).alias(f"{c}_cents")
              for c in schemas.CLEAN_NUMBERS],
        )
    )


# --- merge -----------------------------------------------------------------------
MERGED = ("asin", "title", "price", "original_price", "rating", "product_url", "brand",
          "manufacturer", "availability", "seller", "color", "category")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = views.raw_records(spark, sf_dir)
    split = F.col("batch_date") < F.lit("1998-01-01").cast("date")
    columns = ["seq", *MERGED]
    return raw.where(split).select(*columns), raw.where(~split).select(*columns)


def merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(merge.merge_batches(*_halves(spark, sf_dir)))


def enrich_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = views.raw_records(spark, sf_dir).select(
        "seq", "asin", "price", "original_price", "brand", "manufacturer", "availability", "seller", "color"
    )
    return merge.enrich(listing, views.details(spark, sf_dir))


def detail_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = views.details(spark, sf_dir)
    new = views.raw_records(spark, sf_dir).select(
        "seq", "asin", "price", "original_price", "brand", "manufacturer", "availability", "seller", "color"
    )
    return merge.update_cache(cache, new).select(*cache.columns)


def detail_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cache lacks that holds every customer but each third."""
    cached = views.table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(
        F.concat(F.lit("SKU"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("asin_key")
    )
    return merge.detail_worklist(views.raw_records(spark, sf_dir), cached)


def detail_worklist_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred of an empty cache's work-list."""
    raw = views.raw_records(spark, sf_dir)
    return merge.detail_worklist(raw, raw.select(F.lit("").alias("asin_key")), 100)


# --- warehouse -------------------------------------------------------------------
def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dimension.evolve_dim(views.dim_products(spark, sf_dir))
    merged = dimension.upsert(dim, views.line_stage(spark, sf_dir), LOAD_TIME)
    return plain(merged.select(
        "product_id", "sku", "title", "product_name", "brand", "device_type", "color", "created_at", "updated_at"
    ))


def fact_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = views.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("SKU"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("sku"),
    )
    batch = clean.scored(views.full_raw(views.raw_records(spark, sf_dir))).transform(clean.to_clean, "seq")
    stage = dimension.with_load_defaults(batch)
    return plain(facts.sweep_facts(facts.append_facts(stage, dim, LOAD_TIME, batch_id=1, last_id=1000)))


def dim_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = views.order_products(spark, sf_dir)
    return plain(dimension.backfill(dim, LOAD_TIME).select(
        "product_id", "product_name", "brand", "device_type", "updated_at", "needs_refresh"
    ))


def missing_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(dimension.sweep_dim(views.order_products(spark, sf_dir)).select(
        "product_id", "title", "product_name", "brand", "device_type", "color"
    ))


def fact_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = views.raw_records(spark, sf_dir).select(
        "seq", "availability", "seller", F.when(F.col("seq") % 2 == 0, F.lit(" ")).alias("currency")
    )
    return facts.sweep_facts(fact)


def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(dimension.evolve_dim(views.order_products(spark, sf_dir)))


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings of raw records, each loaded by one run of the stream."""
    prepare(spark)
    base = work_folder(spark, "incremental")
    raw = views.raw_records(spark, sf_dir)
    first, second = (F.col("batch_date") < F.lit(day).cast("date") for day in PERIODS)
    landing = F.when(first, 0).when(second, 1).otherwise(2)
    for number in range(3):
        landed = raw.where(landing == number)
        views.full_raw(landed).write.mode("append").parquet(f"{base}/landing")
        run_incremental(
            spark, f"{base}/landing", views.full_raw(raw).schema, f"{base}/warehouse", f"{base}/checkpoint",
            clock=lambda _: LOAD_TIME,
        )
    warehouse = Warehouse(spark, f"{base}/warehouse")
    fact = warehouse.fact().groupBy("product_id").agg(
        F.count(F.lit(1)).alias("snapshots"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"), F.sum("discount_percent").alias("discounts"),
    )
    return plain(
        warehouse.dim().join(fact, "product_id")
        .select("sku", "snapshots", "min_price", "max_price", "discounts")
    )


def warehouse_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables taken over, a batch load and a stream's load with the same batch id; the batch load is repeated."""
    prepare(spark)
    warehouse = Warehouse(spark, work_folder(spark, "history"))
    warehouse.adopt(views.dim_products(spark, sf_dir), views.snapshots(spark, sf_dir))
    raw = views.raw_records(spark, sf_dir)
    first, second = (F.col("batch_date") < F.lit(day).cast("date") for day in PERIODS)
    for writer, period in (("batch", first), ("batch", first), ("stream", ~first & second)):
        batch = clean.transform(views.full_raw(raw.where(period)))
        warehouse.load(batch, LOAD_TIME, batch_id=1, writer=writer)
    facts_now = warehouse.fact().agg(
        F.count(F.lit(1)).alias("snapshots"), F.countDistinct("snapshot_id").alias("ids"),
        F.sum((F.col("price") * 100).cast("long")).alias("price_cents"),
    )
    products = warehouse.dim().agg(F.count(F.lit(1)).alias("n")).scalar()
    return facts_now.withColumn("products", products)


def warehouse_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables made empty, made again, and loaded."""
    prepare(spark)
    warehouse = Warehouse(spark, work_folder(spark, "create"))
    warehouse.create()
    warehouse.create()
    before = warehouse.dim().count() + warehouse.fact().count()
    warehouse.load(clean.transform(views.full_raw(views.raw_records(spark, sf_dir))), LOAD_TIME)
    unique = warehouse.dim().agg((F.count(F.lit(1)) - F.countDistinct("sku")).alias("n")).scalar()
    return warehouse.batches().select(
        "writer", "batch_id", "snapshots", F.lit(before).cast("long").alias("rows_before"), unique.alias("repeated_skus")
    )


def batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job into two warehouses: twice with pages, once from raw, once from clean data.

    Two runs look up the details of 100 products each.
    """
    prepare(spark)
    base = work_folder(spark, "job")
    for df, name in zip(views.shop_pages(spark, sf_dir), ("listing", "details")):
        df.write.parquet(f"{base}/{name}")
    roots = (f"{base}/first", f"{base}/second")
    config = batch.BatchConfig(f"{base}/data", roots, f"{base}/listing", f"{base}/details", max_details=100)
    modes = (batch.FULL, batch.FULL, batch.SKIP_EXTRACT, batch.LOAD_ONLY)
    for hour, mode in enumerate(modes):
        at = LOAD_TIME + timedelta(hours=hour)
        batch.run(spark, config, mode, at, now=lambda at=at: at)
    found = []
    for name, root in zip(("first", "second"), roots):
        warehouse = Warehouse(spark, root)
        facts_of = warehouse.fact().groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.max("price").alias("price"))
        found.append(warehouse.dim().join(shuffled(facts_of), "product_id").select(
            F.lit(name).alias("warehouse"), "sku", "title", "color", F.col("n").alias("snapshots"), "price"
        ))
    return plain(found[0].unionByName(found[1]))


# --- files -----------------------------------------------------------------------
def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.read_pages(spark, f"{sf_dir}/pages.parquet")
    return found.select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


def raw_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records published twice: readers get the second set as a whole."""
    path = work_folder(spark, "sink")
    raw = views.full_raw(views.raw_records(spark, sf_dir))
    files.write_raw(raw.where("seq % 2 = 0"), path)
    files.write_raw(raw, path)
    return files.read_raw_current(spark, path).select("seq", "asin", "product_url", "title", "price", "color")


def report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a flawed batch, written before the gate raises."""
    path = work_folder(spark, "report")
    summary = quality.summarize(quality.checked_write(views.flawed_batch(spark, sf_dir).withColumn("seq", F.lit(1)), f"{path}/clean"))
    files.write_report(summary, f"{path}/report")
    back = spark.read.schema(summary.schema).json(f"{path}/report")
    try:
        quality.gate(back)
        stopped = False
    except quality.QualityError:
        stopped = True
    return back.select(
        "status", F.lit(stopped).cast("long").alias("stopped"), F.size("failures").cast("long").alias("failures"),
        F.size("warnings").cast("long").alias("warnings"),
    )


def profile_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile tables through their CSV files."""
    path = work_folder(spark, "profiles")
    clean_batch = views.clean_batch(spark, sf_dir)
    made = {"device": profile.value_counts(clean_batch, "device_type"), "brand": profile.value_counts(clean_batch, "brand", 20)}
    files.write_profiles(made, path)
    tables = [
        spark.read.schema("name string, products long").option("header", True).csv(f"{path}/{n}").withColumn("profile", F.lit(n))
        for n in made
    ]
    return tables[0].unionByName(tables[1])


def dq_flaws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate(views.flawed_batch(spark, sf_dir))


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records through files that each hold one JSON array."""
    path = work_folder(spark, "arrays")
    raw = views.full_raw(views.raw_records(spark, sf_dir))
    record = F.struct(*[f.name for f in views.schemas.RAW_SCHEMA])
    arrays = raw.groupBy(F.floor(F.col("seq") / 10_000).alias("part")).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.read_raw(spark, path).select("asin", "product_url", "title", "price", "rating", "seller", "color")


def clean_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean batch through its CSV file."""
    path = work_folder(spark, "clean-csv")
    files.write_clean(clean.transform(views.full_raw(views.raw_records(spark, sf_dir))), path)
    back = files.read_clean(spark, path)
    return plain(back.select("sku", "title", "product_name", "price", "original_price", "discount_percent", "rating", "color"))


def dq_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with too few rows and without two columns."""
    return quality.validate(views.clean_batch(spark, sf_dir).drop("seller", "price"), min_rows=10**12)


# --- pages -----------------------------------------------------------------------
def blocked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.when(F.col("page_id") % 7 == 0, F.concat("html", F.lit("<b>OPFcaptcha</b>"))).otherwise(F.col("html"))
    found = views.table(spark, sf_dir, "pages").withColumn("html", html)
    return pages.drop_blocked(found).select("page_id", "url")


def listing_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract_listings(views.listing_pages(spark, sf_dir))
    return found.withColumn("listing_badges", F.array_join("listing_badges", "|"))


def listing_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract_listings(views.listing_variants(spark, sf_dir))
    return found.select(
        "page_id", "asin", "title", "price", "original_price", "rating", "product_url", F.array_join("listing_badges", "|").alias("badges")
    )


def detail_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pages.extract_details(views.detail_variants(spark, sf_dir)).select(
        "page_id", "page_code", "price", "original_price", "seller"
    )


def detail_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = pages.extract_details(views.detail_pages(spark, sf_dir))
    entries = F.array_sort(
        F.transform(F.map_entries("product_specs"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    )
    return found.select(
        "page_id", "page_code",
        *[c for c in schemas.DETAIL_FIELDS if c not in ("bullet_points", "product_specs")],
        F.array_join("bullet_points", "|").alias("bullet_points"),
        F.array_join(entries, "|").alias("product_specs"),
    )


def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_records(spark, sf_dir)
    return raw.select(
        "seq",
        urls.canonical_url(F.col("asin")).alias("canonical"),
        urls.normalize_url(F.col("product_url")).alias("normalized"),
        urls.identity(F.col("asin"), F.col("product_url"), F.col("seq")).alias("identity"),
    )


def seller_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = (
        "Sold by: {}", "{}  and Fulfilled by Amazon now", "Shipper / Seller {}", "{} {}",
        "seller {} Returns within 30 days", "amazon", "{}",
    )
    key = F.col("s_suppkey")
    made = [F.replace(F.lit(s), F.lit("{}"), F.col("s_name")) for s in shapes]
    line = views.table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.get(F.array(*made), (key % len(shapes)).cast("int")).alias("seller")
    )
    return line.select("s_suppkey", pages.clean_seller(F.col("seller")).alias("seller"))


# --- quality, dashboard ------------------------------------------------------------
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate(views.clean_batch(spark, sf_dir), min_rows=1)


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and number of broken rules of the transformed raw records."""
    batch = clean.transform(views.raw_records(spark, sf_dir)).drop("seq")
    return quality.summarize(quality.validate(batch)).select(
        "status", F.size("failures").cast("long").alias("failures"),
        F.size("warnings").cast("long").alias("warnings"),
    )


def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.validate(views.clean_batch(spark, sf_dir))
    return measures.quality_score(report).select(cents_up(F.col("data_quality_score"), 6).alias("score"))


def _both(f: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(
        f(views.dim_products(spark, sf_dir), views.snapshots(spark, sf_dir))
    )


def _batch(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(f(views.clean_batch(spark, sf_dir)))


def _measured(by: list[str]) -> Query:
    def run(dim: DataFrame, fact: DataFrame) -> DataFrame:
        return measures.measures(dim, fact, by, HIGH_DISCOUNT).withColumn(
            "price_change_percent", cents_up(F.col("price_change_percent").cast("double"), 4)
        )
    return _both(run)


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.freshness(views.snapshots(spark, sf_dir), NOW))


def describe(df: DataFrame) -> DataFrame:
    found = profile.describe(df)
    return found.select(
        "column_name", "count",
        *[cents_up(F.col(c), 4).alias(c) for c in found.columns if c not in ("column_name", "count")],
    )


def overview(df: DataFrame) -> DataFrame:
    return profile.overview(df).withColumn("value", cents_up(F.col("value"), 4))


def price_by_device(df: DataFrame) -> DataFrame:
    found = profile.price_by_device(df)
    return found.select(
        "device_type", "products",
        *[cents_up(F.col(c), 4).alias(c) for c in found.columns[2:]],
    )


def histogram(df: DataFrame) -> DataFrame:
    return _edges(profile.price_histogram(df))


def _edges(df: DataFrame) -> DataFrame:
    return df.select(
        "bin", cents_up(F.col("from_value"), 3).alias("from_value"),
        cents_up(F.col("to_value"), 3).alias("to_value"), "rows",
    )


def name_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.name_audit(views.order_products(spark, sf_dir))


def stale_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.stale_names(views.order_products(spark, sf_dir)).select("product_id", "product_name")


def queries() -> dict[str, Query]:
    c = F.col
    return {
        # reports
        "kpi_summary": _both(reports.kpi_summary),
        "by_device_brand": _both(reports.by_device_brand),
        "daily_price_trend": _both(reports.daily_price_trend),
        "top_rated": _both(reports.top_rated),
        "price_changes": _both(reports.price_changes),
        "best_discounts": _both(reports.best_discounts),
        "table_counts": _both(reports.table_counts),
        "latest_snapshots": _both(lambda dim, fact: reports.latest_snapshots(fact)),
        "named_products": lambda s, d: reports.named_products(views.order_products(s, d)),
        "freshness": freshness,
        "name_audit": name_audit,
        "stale_names": stale_names,
        # text and numbers
        "text_clean": _text_query(clean=text.clean_text),
        "word_count": _text_query(words=text.word_count),
        "trailing_noise": _text_query(noise=text.has_trailing_noise),
        "product_name": _text_query(product_name=text.product_name),
        "capitalize": _text_query(capitalized=text.capitalize),
        "price_parse": _text_query(price=numbers.clean_price),
        "rating_parse": _text_query(rating=numbers.rating_score),
        "availability_clean": _text_query(availability=text.clean_availability),
        "raw_prices": _raw_query(
            price=lambda: numbers.clean_price(c("price")),
            original_price=lambda: numbers.clean_price(c("original_price")),
            rating=lambda: numbers.rating_score(c("rating")),
        ),
        "raw_names": _raw_query(
            product_name=lambda: text.product_name(c("title")),
            words=lambda: text.word_count(c("title")),
            noise=lambda: text.has_trailing_noise(c("title")),
            category=lambda: text.capitalize(c("category")),
        ),
        "raw_availability": _raw_query(
            availability=lambda: text.clean_availability(c("availability")),
            on_page=lambda: text.page_availability(c("availability")),
            shipping=lambda: text.mentions_shipping(c("availability")),
        ),
        "missing_placeholder": _raw_query(
            seller=lambda: text.or_placeholder(c("seller")),
            color=lambda: text.or_placeholder(c("color")),
            missing=lambda: text.is_missing(c("seller")),
            loaded=lambda: text.load_text(c("seller")),
        ),
        "discount_percent": discount_percent,
        # classification
        "device_type": _raw_query(
            device_type=lambda: classify.infer_device_type(c("title"), c("category")),
            like_device=lambda: classify.looks_like_device(c("brand")),
        ),
        "brand": _raw_query(
            brand=lambda: classify.infer_brand(c("title"), c("brand"), c("manufacturer")),
            known=lambda: classify.is_known_brand(c("brand")),
        ),
        "document_classes": _text_query(
            device_type=lambda t: classify.infer_device_type(t),
            brand=lambda t: classify.best_class(F.lower(text.squeeze(t)), classify.K.BRAND_TERMS),
            has_hp=lambda t: classify.has_alias(t, "HP"),
        ),
        "correct_record": _raw_query(
            device_type=lambda: classify.corrected_device(
                c("title"), c("category"), text.capitalize(c("category"))),
            brand=lambda: classify.corrected_brand(
                c("title"), c("brand"), c("manufacturer"),
                classify.corrected_device(c("title"), c("category"), text.capitalize(c("category")))),
        ),
        # clean batch
        "clean_transform": clean_transform,
        "dedup_first": dedup_first,
        "dedup_texts": dedup_texts,
        "repair_prices": repair_prices,
        "dq_report": dq_report,
        "dq_gate": dq_gate,
        # merge
        "merge_batches": merge_batches,
        "enrich_details": enrich_details,
        "detail_cache": detail_cache,
        "detail_worklist": detail_worklist,
        "detail_worklist_capped": detail_worklist_capped,
        # warehouse
        "dim_upsert": dim_upsert,
        "fact_append": fact_append,
        "dim_backfill": dim_backfill,
        "missing_sweep": missing_sweep,
        "fact_sweep": fact_sweep,
        "schema_evolve": schema_evolve,
        "incremental_load": incremental_load,
        "warehouse_history": warehouse_history,
        "warehouse_create": warehouse_create,
        "batch_job": batch_job,
        # files
        "read_pages": read_pages,
        "raw_sink": raw_sink,
        "report_sink": report_sink,
        "profile_sink": profile_sink,
        "dq_flaws": dq_flaws,
        "raw_scan": raw_scan,
        "clean_csv_roundtrip": clean_csv_roundtrip,
        "dq_missing_columns": dq_missing_columns,
        # dashboard
        "measures": _measured([]),
        "measures_by_brand": _measured(["brand"]),
        "measures_by_seller_device": _measured(["seller", "device_type"]),
        "discounted_products": _both(
            lambda dim, fact: measures.measures(dim, fact, ["device_type"], HIGH_DISCOUNT)
            .select("device_type", "discounted_products", "high_discount_products")
        ),
        "products_by_brand": _both(lambda d, f: measures.page_dataset("products_by_brand", d, f)),
        "share_by_device": _both(lambda d, f: measures.page_dataset("products_by_device", d, f)),
        "matrix": _both(lambda d, f: measures.page_dataset("products_by_device_brand", d, f)),
        "matrix_pivot": _both(lambda d, f: measures.device_brand_matrix(
            d, f, ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])),
        "price_over_time": _both(lambda d, f: measures.page_dataset("price_over_time", d, f)),
        "price_over_time_by_device": _both(
            lambda d, f: measures.page_dataset("price_over_time_by_device", d, f)),
        "price_over_time_by_brand": _both(
            lambda d, f: measures.page_dataset("price_over_time_by_brand", d, f)),
        "price_change_by_product": _both(
            lambda d, f: measures.page_dataset("price_change_by_product", d, f)
            .withColumn("price_change_percent", cents_up(c("price_change_percent").cast("double"), 4))),
        "price_vs_discount": _both(
            lambda d, f: measures.page_dataset("price_vs_discount_by_product", d, f)),
        "price_by_brand": _both(lambda d, f: measures.page_dataset("price_by_brand", d, f)),
        "price_vs_discount_by_brand": _both(
            lambda d, f: measures.page_dataset("price_vs_discount_by_brand", d, f)),
        "product_details": _both(measures.product_details),
        "snapshot_growth": _both(lambda d, f: measures.snapshot_growth(f)),
        "freshness_status": _both(lambda d, f: measures.freshness_status(f, NOW)),
        "quality_checks": _both(lambda d, f: measures.quality_checks(d, f, NOW)),
        "quality_score": quality_score,
        # profile
        "column_audit": _batch(profile.column_audit),
        "quality_summary": _batch(profile.quality_summary),
        "column_profile": _batch(profile.column_profile),
        "overview": _batch(overview),
        "device_counts": _batch(lambda df: profile.value_counts(df, "device_type")),
        "top_brands": _batch(lambda df: profile.value_counts(df, "brand", 20)),
        "top_sellers": _batch(lambda df: profile.value_counts(df, "seller", 20)),
        "availability_counts": _batch(lambda df: profile.value_counts(df, "availability", 30)),
        "describe": _batch(describe),
        "price_by_device": _batch(price_by_device),
        "histogram": _batch(histogram),
        "discount_histogram": _batch(lambda df: _edges(profile.discount_histogram(df))),
        "top_priced": _batch(lambda df: profile.top_products(df, "price")),
        "top_discounted": _batch(lambda df: profile.top_products(df, "discount")),
        "top_products": _batch(lambda df: profile.top_products(df, "rating")),
        "completeness": _batch(profile.completeness),
        # pages
        "blocked_pages": blocked_pages,
        "canonical_url": canonical_url,
        "seller_clean": seller_clean,
        "listing_extract": listing_extract,
        "listing_variants": listing_variants,
        "detail_variants": detail_variants,
        "detail_extract": detail_extract,
        "page_extract": lambda s, d: pages.extract_articles(views.table(s, d, "pages")),
    }

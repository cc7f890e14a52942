import random
import re
from datetime import datetime

from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions import fixed as K
from shelfwatch.operators import clean, dimension, facts, merge, quality

RAW = "seq long, asin string, title string, price string, original_price string, rating string, category string, brand string, availability string"
ROWS = [
    (1, "A", "Acme Phone X for kids", "EGP 1,000.00", "1,250", "4.5 out of 5", "google pixel", "Zed", "Ships today"),
    (2, "A", "later", "1", "2", "5", "tablet", None, None),
    (3, "B", "12", "0", "", "none", "tv", None, "in stock"),
    (4, None, "no code", "5", None, None, None, None, None),
    (5, "C", "no price", None, None, None, None, None, None),
    (6, "D", "x", "300", "200", "4,5", "misc", "generic", "N/A"),
    (7, "C", "has price", "7", None, None, None, None, None),
]


def rows(df):
    return {r["sku"]: r.asDict() for r in df.collect()}


def test_transform(spark):
    got = rows(clean.transform(spark.createDataFrame(ROWS, RAW)))
    assert set(got) == {"A", "B", "C", "D"}
    a = got["A"]
    assert (a["product_name"], a["price"], a["original_price"], a["discount_percent"], a["rating"]) == ("Acme Phone X", 1000.0, 1250.0, 20.0, 4.5)
    assert a["device_type"] == "Smartphone" and a["brand"] == "Google" or a["brand"] == "Zed"
    assert a["availability"] == K.PLACEHOLDER
    b = got["B"]
    assert (b["price"], b["original_price"], b["rating"], b["product_name"], b["device_type"]) == (0.0, 0.0, 0.0, K.PLACEHOLDER, "Television")
    assert got["C"]["title"] == "has price"
    d = got["D"]
    assert (d["original_price"], d["discount_percent"], d["rating"], d["availability"]) == (300.0, 0.0, 4.0, "N/A")
    assert d["device_type"] == "Misc" and d["brand"] == K.PLACEHOLDER


def test_transform_ignores_partitioning_and_input_order(spark):
    shuffled = ROWS[:]
    random.Random(3).shuffle(shuffled)
    one = rows(clean.transform(spark.createDataFrame(ROWS, RAW)))
    two = rows(clean.transform(spark.createDataFrame(shuffled, RAW).repartition(5)))
    assert one == two


def test_empty_batch_keeps_all_columns(spark):
    out = clean.transform(spark.createDataFrame([], RAW))
    assert out.drop("seq").columns == list(schemas.CLEAN_COLUMNS) and out.count() == 0


def test_transform_output_passes_the_gate(spark):
    batch = clean.transform(spark.createDataFrame(ROWS, RAW)).drop("seq")
    quality.gate(quality.summarize(quality.validate(batch)))


def test_hot_key_keeps_one_row_per_task_before_the_shuffle(spark):
    hot = spark.range(9000).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("sku"))
    kept = clean.dedup_first(hot)
    assert kept.count() == 6001
    assert [r["seq"] for r in kept.where("sku = 'hot'").collect()] == [0]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()
    assert [r["seq"] for r in clean.dedup_last(hot).where("sku = 'hot'").collect()] == [8997]


MERGE = "seq long, asin string, title string, price string, product_url string, listing_badges array<string>, product_specs map<string,string>"


def test_merge(spark):
    old = spark.createDataFrame([
        (1, "a1", "Old", "10", "/x", ["b"], {"k": "1"}),
        (2, "", "By link", "5", "/dp/1", [], None),
        (3, None, "Alone", "1", None, None, {}),
        (4, " A1 ", "", None, "/y", [], {}),
    ], MERGE)
    new = spark.createDataFrame([
        (1, "A1", "", "0", "", [], {"z": "2"}),
        (2, None, "Link again", "", "/dp/1", ["n"], None),
        (3, None, "Alone too", "2", "", None, None),
    ], MERGE)
    got = {r["identity"]: r.asDict() for r in merge.merge_batches(old, new).collect()}
    assert len(got) == 4
    a = got["asin:A1"]
    # The last non-empty value wins: "0" is one, "" and [] are not.
    assert (a["title"], a["price"], a["product_url"], a["listing_badges"], a["product_specs"]) == ("Old", "0", "/y", ["b"], {"z": "2"})
    assert (a["batch"], a["seq"]) == (0, 1)
    link = got[f"url:{K.SITE_ROOT}/dp/1"]
    assert (link["title"], link["price"], link["listing_badges"]) == ("Link again", "5", ["n"])
    assert sum(k.startswith("row:") for k in got) == 2


def test_merge_keeps_the_side_that_has_rows(spark):
    old = spark.createDataFrame([(1, "A", "t", "1", "", [], {}), (2, "A", "u", "2", "", [], {})], MERGE)
    none = spark.createDataFrame([], MERGE)
    assert merge.merge_or_keep(old, none).count() == 2
    assert merge.merge_or_keep(none, old).count() == 2
    assert merge.merge_or_keep(old, old).count() == 1


def test_enrich_and_cache(spark):
    listing = spark.createDataFrame(
        [(1, "a", "0", "", None), (2, "B", "5", "Own", "x"), (3, "", "1", None, None)],
        "seq long, asin string, price string, brand string, seller string",
    )
    detail = spark.createDataFrame(
        [("A", "99", "Acme", ""), ("B", "1", "Other", "s")], "asin_key string, price string, brand string, seller string"
    )
    got = {r["seq"]: (r["price"], r["brand"], r["seller"]) for r in merge.enrich(listing, detail).collect()}
    assert got == {1: ("0", "Acme", None), 2: ("5", "Own", "x"), 3: ("1", None, None)}
    cache = merge.update_cache(detail, merge.enrich(listing, detail))
    got = {r["asin_key"]: (r["price"], r["brand"]) for r in cache.collect()}
    assert got == {"A": ("0", "Acme"), "B": ("5", "Own")}


def test_worklist(spark):
    listing = spark.createDataFrame([(1, "c"), (2, "A"), (3, "C"), (4, ""), (5, "d"), (6, None)], "seq long, asin string")
    cache = spark.createDataFrame([("A",)], "asin_key string")
    assert {(r[0], r[1]) for r in merge.detail_worklist(listing, cache).collect()} == {("C", 1), ("D", 5)}
    assert [r[0] for r in merge.detail_worklist(listing, cache, 1).collect()] == ["C"]


def test_worklist_of_a_cache_without_codes_compares_no_pairs(spark):
    listing = spark.createDataFrame([(1, "c"), (2, "A"), (3, "C"), (4, "")], "seq long, asin string")
    for code in ("", None):
        cache = listing.select(F.lit(code).cast("string").alias("asin_key"))
        todo = merge.detail_worklist(listing, cache, 100)
        assert [(r[0], r[1]) for r in todo.collect()] == [("C", 1), ("A", 2)]
        assert "NestedLoopJoin" not in todo._jdf.queryExecution().executedPlan().toString()


def test_joins_by_code_never_pass_the_driver(spark, tmp_path):
    """A written table of codes looks small to the planner, however many rows it has."""
    spark.range(200).selectExpr("'P' || id AS asin", "'P' || id AS sku", "id AS seq", "id AS product_id", "current_timestamp()::timestamp_ntz AS created_at", "current_timestamp()::timestamp_ntz AS updated_at").write.parquet(f"{tmp_path}/codes")
    codes = spark.read.parquet(f"{tmp_path}/codes")
    detail = codes.select(F.col("asin").alias("asin_key"), F.lit("x").alias("brand"))
    dim = codes.select("product_id", "sku", "created_at", "updated_at")
    at = datetime(2024, 1, 1)
    made = {
        "enrich": merge.enrich(codes.select("asin", "seq"), detail),
        "worklist": merge.detail_worklist(codes, detail),
        "upsert": dimension.upsert_latest(dim, codes.select("sku"), at, 0),
        "facts": facts.append_facts(codes.select("sku", "seq"), dim, at, 1),
    }
    for name, df in made.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and not re.search(r"BroadcastHashJoin \[(sku|seq|asin_key)", plan), name
    assert made["enrich"].where("brand = 'x'").count() == made["upsert"].count() == made["facts"].count() == 200
    assert made["worklist"].count() == 0

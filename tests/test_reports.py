from datetime import datetime
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.operators import measures, profile, reports, stats
from shelfwatch.operators.stats import exact_percentiles
from shelfwatch.session import kept

DIM = "product_id long, sku string, title string, product_name string, brand string, device_type string"
FACT = ("product_id long, price decimal(10,2), original_price decimal(10,2), discount_percent decimal(5,2), "
        "rating decimal(3,2), availability string, seller string, snapshot_timestamp timestamp_ntz")


def D(x):
    return None if x is None else Decimal(str(x))


@pytest.fixture(scope="module")
def star(spark):
    """Product 1 owns most facts, product 99 is unknown, some values are missing."""
    rng = np.random.default_rng(5)
    dim = [(i, f"S{i}", f"t{i % 5}", f"n{i % 5}", f"b{i % 3}", "x" if i % 2 else "y") for i in range(1, 20)]
    fact = []
    for i in range(600):
        product = 1 if i % 3 == 0 else int(rng.integers(1, 15)) if i % 10 else 99
        fact.append((product, D(int(rng.integers(100, 9000)) / 100), D("95.00"),
                     D(int(rng.integers(0, 40))) if i % 7 else None, D(int(rng.integers(0, 6))) if i % 11 else None,
                     "a", f"s{i % 4}", datetime(2024, 1, 1 + i % 20)))
    d, f = spark.createDataFrame(dim, DIM), spark.createDataFrame(fact, FACT)
    f = f.withColumn("snapshot_date", F.col("snapshot_timestamp").cast("date"))
    joined = pd.DataFrame(fact, columns=[c.split()[0] for c in FACT.replace("decimal(10,2)", "d").replace("decimal(5,2)", "d").replace("decimal(3,2)", "d").split(", ")])
    joined = joined.merge(pd.DataFrame(dim, columns=[c.split()[0] for c in DIM.split(", ")]), on="product_id")
    for c in ("price", "discount_percent", "rating"):
        joined[c] = joined[c].astype(float)
    return d, f, joined


def test_kpi(star):
    dim, fact, j = star
    r = reports.kpi_summary(dim, fact).first()
    assert (r["total_products"], r["total_snapshots"]) == (j.product_id.nunique(), len(j))
    assert float(r["avg_price"]) == pytest.approx(j.price.mean(), abs=0.0051)
    assert float(r["avg_rating"]) == pytest.approx(j.rating.mean(), abs=0.0051)


def test_by_device_brand_and_measures(star):
    dim, fact, j = star
    got = {(r["device_type"], r["brand"]): r for r in reports.by_device_brand(dim, fact).collect()}
    for key, g in j.groupby(["device_type", "brand"]):
        assert got[key]["product_count"] == g.product_id.nunique()
        assert float(got[key]["avg_discount_percent"]) == pytest.approx(g.discount_percent.mean(), abs=0.0051)
    assert len(got) == j.groupby(["device_type", "brand"]).ngroups
    m = {(r["seller"], r["brand"]): r for r in measures.measures(dim, fact, ["seller", "brand"]).collect()}
    for key, g in j.groupby(["seller", "brand"]):
        assert m[key]["total_products"] == g.product_id.nunique() and m[key]["total_snapshots"] == len(g)
        assert m[key]["high_discount_products"] == g[g.discount_percent >= 20].product_id.nunique()
        assert float(m[key]["price_range"]) == pytest.approx(g.price.max() - g.price.min())


def test_measures_of_nothing(star):
    dim, fact, _ = star
    r = measures.measures(dim, fact.limit(0)).first()
    assert (r["total_products"], r["total_snapshots"], r["average_price"], r["price_change_percent"]) == (0, 0, None, None)


def test_best_discounts_with_unknown_products(star, spark):
    dim, fact, j = star
    shown = ["discount_percent", "price"]
    expected = j[j.discount_percent.notna()].sort_values(shown, ascending=[False, True])[shown].head(20)
    got = [(float(r["discount_percent"]), float(r["price"])) for r in reports.best_discounts(dim, fact).collect()]
    assert got == [tuple(r) for r in expected.itertuples(index=False)]
    # All of the best facts belong to unknown products: no bound, still exact.
    orphans = fact.where("discount_percent is not null").withColumns({"product_id": F.lit(99).cast("long"), "discount_percent": F.lit(99).cast("decimal(5,2)")})
    both = fact.unionByName(orphans)
    got = [(float(r["discount_percent"]), float(r["price"])) for r in reports.best_discounts(dim, both).collect()]
    assert got == [tuple(r) for r in expected.itertuples(index=False)]
    assert reports.best_discounts(dim, fact.limit(0)).count() == 0
    assert reports.best_discounts(dim.where("product_id = 3"), fact, n=500).count() == len(j[(j.product_id == 3) & j.discount_percent.notna()])


def test_top_rated_puts_unrated_first(spark):
    dim = spark.createDataFrame([(1, "a", "t", "n1", "b", "x"), (2, "b", "t", "n2", "b", "x")], DIM)
    fact = spark.createDataFrame([(1, D(5), None, None, D(5), "", "", None), (2, D(1), None, None, None, "", "", None)], FACT)
    assert [r["product_name"] for r in reports.top_rated(dim, fact).collect()] == ["n2", "n1"]


def test_freshness(spark):
    now = datetime(2024, 1, 3, 12, 10)
    fact = spark.createDataFrame([(datetime(2024, 1, 2, 5, 50),)], "snapshot_timestamp timestamp_ntz")
    r = reports.freshness(fact, now).first()
    assert r["age_hours"] == pytest.approx(30 + 20 / 60) and r["hours_crossed"] == 31 and not r["fresh"]
    r = reports.freshness(fact, now, 30.5).first()
    assert r["fresh"] and not r["fresh_by_hour"]
    none = reports.freshness(fact.limit(0), now).first()
    assert none["latest_snapshot"] is None and none["fresh"] is False
    assert measures.freshness_status(fact, now).first()["freshness_status"] == "Fresh"
    assert measures.freshness_status(fact, datetime(2024, 1, 4)).first()["freshness_status"] == "Stale"


def test_name_audit_counts_double_blanks(spark):
    names = ["a b c d e", "a b  c d e", "Acme and", "Acme 1,5", None, " ", "Acme"]
    dim = spark.createDataFrame([(i, str(i), "t", n, "b", "d") for i, n in enumerate(names)], DIM)
    assert sorted(r["product_id"] for r in reports.name_audit(dim).collect()) == [1, 2, 3, 4, 5]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", None, "b"]), st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))), min_size=1, max_size=40))
def test_percentiles_equal_numpy(spark, rows):
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {(r["g"], r["prob"]): r["value"] for r in exact_percentiles(df, "x", probs, by=["g"]).collect()}
    expected = {}
    for g in {g for g, _ in rows}:
        xs = [x for k, x in rows if k == g and x is not None]
        if xs:
            expected.update({(g, p): float(np.percentile(xs, p * 100)) for p in probs})
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert got[k] == pytest.approx(v, rel=1e-9, abs=1e-9)


def test_percentiles_with_a_hot_value(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") * 13.37).alias("x"))
    xs = df.toPandas().x
    got = {r["prob"]: r["value"] for r in exact_percentiles(df, "x", [0.1, 0.5, 0.999]).collect()}
    for p, v in got.items():
        assert v == pytest.approx(xs.quantile(p), rel=1e-12)


def test_percentiles_of_many_close_values_stay_spread(spark, monkeypatch):
    """A million different values between 0 and 1: several partitions, none with most of them."""
    seen = []
    monkeypatch.setattr(stats, "kept", lambda df, purpose: seen.append(kept(df, purpose)) or seen[-1])
    df = spark.range(1_000_000).select((F.xxhash64("id") / 2.0**64 + 0.5).alias("x"))
    found = exact_percentiles(df, "x", [0.25, 0.999])
    xs = df.toPandas().x
    for r in found.collect():
        assert r["value"] == pytest.approx(xs.quantile(r["prob"]), rel=1e-12)
    sizes = [r["count"] for r in seen[0].groupBy("_bucket").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 500_000
    # Windows without a key run over one row for each partition.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Window [" in line and "_value" in line and "_bucket" not in line]


def test_weighted_percentiles(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (9.0, 96)], "x double, n long")
    got = {r["prob"]: r["value"] for r in exact_percentiles(df, "x", [0.01, 0.03, 0.5], weight="n").collect()}
    xs = np.repeat([1.0, 2.0, 9.0], [3, 1, 96])
    assert all(v == pytest.approx(np.percentile(xs, p * 100)) for p, v in got.items())


def test_histogram_reads_the_batch_once(spark, tmp_path):
    flat(spark, [float(i % 17) for i in range(100)]).write.parquet(str(tmp_path / "b"))
    made = profile.price_histogram(spark.read.parquet(str(tmp_path / "b")))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and str(tmp_path / "b") not in plan
    assert sum(r["rows"] for r in made.collect()) == 100


def test_best_discounts_plan_is_the_same_with_orphans(star, spark):
    import re

    dim, fact, _ = star
    orphans = fact.withColumn("product_id", F.lit(99).cast("long"))

    def operators(df):
        return re.findall(r"[A-Z]\w+(?= )", re.sub(r"#\d+|Union|LocalTableScan", "", df._jdf.queryExecution().sparkPlan().toString()).split("Range")[0])[:8]

    assert operators(reports.best_discounts(dim, fact)) == operators(reports.best_discounts(dim, orphans.unionByName(fact)))
    assert reports.best_discounts(dim, orphans).count() == 0


def flat(spark, values, column="price"):
    made = [tuple(v if f.name == column else ("s" if f.dataType.typeName() == "string" else None) for f in schemas.CLEAN_SCHEMA) for v in values]
    return spark.createDataFrame(made, schemas.CLEAN_SCHEMA)


def test_histogram_equals_numpy(spark):
    values = [float(v) for v in np.random.default_rng(1).integers(1, 500, 300)]
    got = [r["rows"] for r in profile.histogram(flat(spark, values), "price", 40).orderBy("bin").collect()]
    assert got == list(np.histogram(values, 40)[0])
    clipped = np.minimum(values, np.percentile(values, 90))
    got = [r["rows"] for r in profile.histogram(flat(spark, values), "price", 10, clip=0.9).orderBy("bin").collect()]
    assert got == list(np.histogram(clipped, 10)[0])
    assert sum(r["rows"] for r in profile.histogram(flat(spark, [2.0, 2.0]), "price", 4).collect()) == 2
    assert profile.histogram(flat(spark, [None]), "price", 4).count() == 0


def test_describe_equals_pandas(spark):
    values = [1.5, 2.0, None, 7.25, 100.0, 3.0]
    r = profile.describe(flat(spark, values), ["price"]).first()
    d = pd.Series(values).describe(percentiles=[0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99])
    assert r["count"] == d["count"]
    for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p01", "1%"), ("p25", "25%"), ("p50", "50%"), ("p99", "99%"), ("max", "max")):
        assert r[ours] == pytest.approx(d[theirs])


def test_counts_and_completeness(spark):
    df = flat(spark, ["a", None, "NA", " ", "a"], "seller")
    assert [(r["seller"], r["products"]) for r in profile.value_counts(df, "seller").collect()] == [("a", 2), (" ", 1), ("NA", 1), ("Not available", 1)]
    r = profile.completeness(df, ["seller"]).first()
    assert (r["available_rows"], r["unavailable_or_blank_rows"], r["available_percent"]) == (2, 3, 40.0)
    p = {x["column_name"]: x for x in profile.column_profile(df).collect()}
    assert (p["seller"]["null_count"], p["seller"]["unique_count"], p["seller"]["not_available_count"]) == (1, 3, 3)
    a = {x["column_name"]: x for x in profile.column_audit(df.drop("title").withColumn("extra", F.lit(1))).collect()}
    assert not a["title"]["is_present"] and a["extra"]["is_present"] and not a["extra"]["is_required"] and a["seller"]["filled_rows"] == 4


def test_top_products_nulls_last(spark):
    got = [r["price"] for r in profile.top_products(flat(spark, [None, 3.0, 9.0]), "price").collect()]
    assert got == [9.0, 3.0, None]


def test_pages_are_all_known(star):
    dim, fact, _ = star
    for name in measures.PAGES:
        assert measures.page_dataset(name, dim, fact).count() > 0
    with pytest.raises(KeyError):
        measures.page_dataset("other", dim, fact)
    assert measures.device_brand_matrix(dim, fact, ["x", "y"]).columns == ["brand", "x", "y", "other"]
    checks = {r["check_name"]: r["bad_rows"] for r in measures.quality_checks(dim, fact, datetime(2024, 1, 21)).collect()}
    assert checks == {"duplicate_sku": 0, "missing_brand": 0, "missing_price": 0, "invalid_ratings": 0, "warehouse_freshness": 0}

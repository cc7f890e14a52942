import pytest
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions import fixed as K
from shelfwatch.operators import quality

GOOD = {
    **{c: "text" for c in schemas.CLEAN_COLUMNS}, "sku": "S1", "product_name": "Acme Phone",
    "price": 10.0, "original_price": 12.0, "discount_percent": 16.67, "rating": 4.0, "availability": K.IN_STOCK,
}


def broken(spark, *changes, columns=schemas.CLEAN_COLUMNS):
    made = [{**GOOD, "sku": f"S{i}", **c} for i, c in enumerate(changes)]
    schema = schemas.CLEAN_SCHEMA
    df = spark.createDataFrame([tuple(r[f.name] for f in schema) for r in made], schema).select(*columns)
    report = quality.validate(df)
    return {(r["rule"], r["column_name"]): r["bad_rows"] for r in report.collect() if r["bad_rows"]}, report


def test_good_batch(spark):
    bad, report = broken(spark, {}, {"color": K.PLACEHOLDER}, {"color": "N/A"})
    assert bad == {}
    quality.gate(quality.summarize(report))


@pytest.mark.parametrize("change, rules", [
    ({"title": None}, {("required_not_null", "title"), ("null_cell", "title"), ("missing_marker", "title")}),
    ({"color": None}, {("null_cell", "color"), ("missing_marker", "color")}),
    ({"seller": " Unknown "}, {("missing_marker", "seller")}),
    ({"seller": "  "}, {("missing_marker", "seller"), ("blank_text", "seller")}),
    ({"availability": "ships soon"}, {("shipping_in_availability", "availability")}),
    ({"product_name": "Acme for"}, {("noise_at_name_end", "product_name")}),
    ({"product_name": "a b c d e f"}, {("long_name", "product_name")}),
    ({"product_name": ""}, {("blank_name", "product_name"), ("blank_text", "product_name"), ("missing_marker", "product_name")}),
    ({"price": -1.0}, {("negative_price", "price")}),
    ({"rating": 5.1}, {("rating_range", "rating")}),
    ({"discount_percent": 100.5}, {("discount_range", "discount_percent")}),
    ({"original_price": 9.0}, {("original_below_price", "original_price")}),
    ({"sku": "S0"}, {("duplicate_sku", "sku")}),
])
def test_each_rule(spark, change, rules):
    bad, report = broken(spark, {}, change)
    assert set(bad) == rules and set(bad.values()) == {1}
    summary = quality.summarize(report)
    if rules <= {("original_below_price", "original_price"), ("duplicate_sku", "sku")}:
        quality.gate(summary)
        assert len(summary.first()["warnings"]) == 1
    else:
        with pytest.raises(quality.QualityError):
            quality.gate(summary)


def test_missing_columns_skip_row_rules(spark):
    bad, _ = broken(spark, {"rating": 9.0}, columns=[c for c in schemas.CLEAN_COLUMNS if c != "seller"])
    assert bad == {("required_column", "seller"): 1}


def test_too_few_rows(spark):
    df = spark.createDataFrame([], schemas.CLEAN_SCHEMA)
    assert {r["rule"] for r in quality.validate(df).collect() if r["bad_rows"]} == {"min_rows"}
    assert all(r["bad_rows"] == 0 for r in quality.validate(df, 0).collect())


def test_checked_write_gives_the_same_report(spark, tmp_path):
    rows = [(1, "A", "x  ", "Acme and", 5.0, 6.0), (2, "A", None, "", -1.0, 9.0), (3, None, "N/A", "one two three four five six", None, 2.0)]
    made = spark.createDataFrame(rows, "seq long, sku string, title string, product_name string, price double, rating double")
    for f in schemas.CLEAN_SCHEMA:
        if f.name not in made.columns:
            made = made.withColumn(f.name, F.lit(None if f.dataType.typeName() == "double" else "unknown").cast(f.dataType))
    for df, name in ((made, "a"), (made.limit(0), "b"), (made.drop("seller"), "c")):
        got = quality.checked_write(df, str(tmp_path / name), 2)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.validate(df.drop("seq"), 2).collect()))
        back = spark.read.parquet(str(tmp_path / name))
        assert back.columns == df.columns and back.count() == df.count()

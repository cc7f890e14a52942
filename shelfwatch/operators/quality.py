"""Quality rules over a clean batch and the gate behind them.

All row rules are counted in one pass with one result row per task; only the duplicate
check needs a shuffle, and that reads just the sku column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions import fixed as K
from shelfwatch.functions import text

FAILURE, WARNING = "failure", "warning"
REPORT_COLUMNS = ("rule", "severity", "column_name", "bad_rows")
NON_NULL = ("sku", "title", "product_name", "price", "device_type")


class QualityError(ValueError):
    """A batch broke at least one failure rule."""


# What a text cell is; found once per cell, counted by several rules.
_FINE, _NULL, _BLANK, _MARKER = 0, 1, 2, 3
_MARKERS = tuple(m for m in K.CLEAN_MISSING if m != K.PLACEHOLDER.lower())


def _state(column: str) -> str:
    return f"_state_{column}"


def _with_states(df: DataFrame) -> DataFrame:
    def state(c: Column) -> Column:
        return (
            F.when(c.isNull(), _NULL)
            .when(text.is_word_of(c, _MARKERS), F.when(text.is_blank(c), _BLANK).otherwise(_MARKER))
            .otherwise(_FINE)
        )

    # Computed here, not inside the aggregate, which so stays fully compiled.
    name = F.col("product_name")
    found = {
        "_noise": text.has_trailing_noise(name),
        "_words": text.word_count(name),
        "_shipping": text.mentions_shipping(F.col("availability")),
    }
    return df.withColumns(
        found | {_state(f.name): state(F.col(f.name)) for f in df.schema if f.dataType.typeName() == "string"}
    )


def _row_rules(df: DataFrame) -> list[tuple[str, str, str, Column]]:
    """(rule, severity, column, condition for a bad row)."""
    texts = [f.name for f in df.schema if f.dataType.typeName() == "string"]
    numbers = {f.name for f in df.schema} - set(texts)

    def is_null(c: str) -> Column:
        return F.col(_state(c)) == _NULL if c in texts else F.col(c).isNull()

    rules = [("required_not_null", FAILURE, c, is_null(c)) for c in NON_NULL]
    rules += [("null_cell", FAILURE, c, is_null(c)) for c in df.columns]
    # A null reads as the text "nan" here, so it counts as a marker too.
    rules += [("missing_marker", FAILURE, c, F.col(_state(c)) != _FINE) for c in texts]
    rules += [("blank_text", FAILURE, c, F.col(_state(c)) == _BLANK) for c in texts]
    rules.append(
        ("shipping_in_availability", FAILURE, "availability", F.col("_shipping"))
    )
    rules += [
        ("blank_name", FAILURE, "product_name", F.col(_state("product_name")) == _BLANK),
        ("noise_at_name_end", FAILURE, "product_name", F.col("_noise")),
        ("long_name", FAILURE, "product_name", F.col("_words") > K.NAME_MAX_WORDS),
    ]
    price, original = F.col("price"), F.col("original_price")
    rules += [
        ("negative_price", FAILURE, "price", price < 0),
        ("rating_range", FAILURE, "rating", ~F.col("rating").between(0, 5)),
        ("original_below_price", WARNING, "original_price", original < price),
        ("discount_range", FAILURE, "discount_percent", ~F.col("discount_percent").between(0, 100)),
    ]
    assert {"price", "rating"} <= numbers, "price and rating have to be numbers"
    return rules


def _long(counts: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """One row of counters (c0, c1, ...) to one row per rule."""
    entries = F.array(
        *[
            F.struct(
                F.lit(r).alias("rule"), F.lit(s).alias("severity"),
                F.lit(c).alias("column_name"), F.col(f"c{i}").cast("long").alias("bad_rows"),
            )
            for i, (r, s, c) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(entries))


def _too_few(min_rows: int) -> Column:
    return F.greatest(F.lit(min_rows) - F.count(F.lit(1)), F.lit(0)).alias("c0")


def _duplicates(clean: DataFrame) -> DataFrame:
    extra = (
        clean.groupBy("sku").agg((F.count(F.lit(1)) - 1).alias("more"))
        .agg(F.coalesce(F.sum("more"), F.lit(0)).alias("c0"))
    )
    return _long(extra, [("duplicate_sku", WARNING, "sku")])


def checked_write(clean: DataFrame, path: str, min_rows: int = 1) -> DataFrame:
    """Write a clean batch (with ``seq``) as Parquet; the report that ``validate`` gives on it.

    The rules are counted while the batch is written; only the skus are read again.
    """
    spark = clean.sparkSession
    checked = clean.drop("seq")
    if any(c not in checked.columns for c in schemas.REQUIRED_COLUMNS):
        clean.write.mode("overwrite").parquet(path)
        return validate(spark.read.schema(clean.schema).parquet(path).drop("seq"), min_rows)
    rules = _row_rules(checked)
    heads = [("min_rows", FAILURE, "*"), *((r, s, c) for r, s, c, _ in rules)]
    seen = Observation()
    counters = [F.count_if(bad).cast("long").alias(f"c{i + 1}") for i, (_, _, _, bad) in enumerate(rules)]
    observed = _with_states(clean).observe(seen, _too_few(min_rows).cast("long").alias("c0"), *counters)
    observed.select(*clean.columns).write.mode("overwrite").parquet(path)
    counts = seen.get
    rows = [(r, s, c, int(counts[f"c{i}"])) for i, (r, s, c) in enumerate(heads)]
    counted = spark.createDataFrame(rows, "rule string, severity string, column_name string, bad_rows long")
    return counted.unionByName(_duplicates(spark.read.schema(clean.schema).parquet(path)))


def validate(clean: DataFrame, min_rows: int = 1) -> DataFrame:
    """Report of all rules in long form: rule, severity, column, bad rows.

    With columns missing or no rows, the row rules are skipped.
    """
    spark = clean.sparkSession
    missing = [c for c in schemas.REQUIRED_COLUMNS if c not in clean.columns]
    shape = [("min_rows", FAILURE, "*")]
    too_few = _too_few(min_rows)
    if missing:
        absent = spark.createDataFrame(
            [("required_column", FAILURE, c, 1) for c in missing],
            "rule string, severity string, column_name string, bad_rows long",
        )
        return _long(clean.agg(too_few), shape).unionByName(absent)

    rules = _row_rules(clean)
    heads = shape + [(r, s, c) for r, s, c, _ in rules]
    counters = [F.count_if(bad).alias(f"c{i + 1}") for i, (_, _, _, bad) in enumerate(rules)]
    counted = _long(_with_states(clean).agg(too_few, *counters), heads)
    return counted.unionByName(_duplicates(clean))


def summarize(report: DataFrame, row_count: int | None = None) -> DataFrame:
    """One row: status, and the broken rules as ``rule(column)=rows`` lists."""
    entry = F.format_string("%s(%s)=%d", "rule", "column_name", "bad_rows")

    def broken(severity: str) -> Column:
        hit = (F.col("severity") == severity) & (F.col("bad_rows") > 0)
        return F.array_sort(F.collect_list(F.when(hit, entry)))

    return report.agg(broken(FAILURE).alias("failures"), broken(WARNING).alias("warnings")).withColumn(
        "status", F.when(F.size("failures") > 0, F.lit("failed")).otherwise(F.lit("passed"))
    )


def gate(summary: DataFrame) -> None:
    """Raise if the summary says the batch failed (a single small row is read)."""
    row = summary.first()
    if row["status"] == "failed":
        raise QualityError("quality check failed: " + "; ".join(row["failures"]))

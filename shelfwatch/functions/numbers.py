"""Prices, discounts, ratings."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwatch.functions import fixed as K
from shelfwatch.functions.text import clean_text, let


def _digit_table() -> tuple[str, str]:
    """Every decimal digit of any script, and its ASCII counterpart."""
    digits = [
        chr(c) for c in range(128, sys.maxunicode + 1)
        if unicodedata.category(chr(c)) == "Nd"
    ]
    return "".join(digits), "".join(str(unicodedata.digit(d)) for d in digits)


FOREIGN_DIGITS, ASCII_DIGITS = _digit_table()


def _to_double(number: Column) -> Column:
    """Text to double; anything that is no number gives null (ANSI safe)."""
    return let(
        number,
        lambda n: F.when(n.rlike(r"^[0-9.]*\z"), n)
        .otherwise(F.translate(n, FOREIGN_DIGITS, ASCII_DIGITS)).try_cast("double"),
    )


def clean_price(col: Column) -> Column:
    """First run of digits, commas and dots in the text, as a number.

    Commas are thousands marks; with two or more dots these are as well.
    """
    run = F.replace(F.regexp_extract(col, rf"[{K.DIGIT},.]+", 0), F.lit(","), F.lit(""))
    return _to_double(
        let(
            run,
            lambda r: F.when(r.rlike(r"\..*\."), F.replace(r, F.lit("."), F.lit(""))).otherwise(r),
        )
    )


def rating_score(col: Column) -> Column:
    """First run of digits and dots; text that is no number gives null."""
    return _to_double(F.regexp_extract(col.cast("string"), rf"[{K.DIGIT}.]+", 0))


def discount_percent(price: Column, original: Column) -> Column:
    """Percent off the original price, two places, ties up.

    Exact decimal division where the amounts fit; the plain double otherwise.
    """
    p, o = price.try_cast("decimal(20,6)"), original.try_cast("decimal(20,6)")
    exact = F.round((o - p) * F.lit(100) / F.nullif(o, F.lit(0).cast("decimal(20,6)")), 2)
    rough = F.round(F.try_divide((original - price) * F.lit(100.0), original), 2)
    return F.when(
        (original > 0) & (price <= original),
        F.coalesce(exact.cast("double"), rough.cast("double")),
    )


def final_discount(scraped: Column, price: Column, original: Column) -> Column:
    """The percent found on the page if there is one, else the computed one."""
    return F.coalesce(clean_price(scraped.cast("string")), discount_percent(price, original))


def currency(*amounts: Column) -> Column:
    """One market, one currency: marked, other and missing amounts all give it."""
    return F.lit(K.CURRENCY)

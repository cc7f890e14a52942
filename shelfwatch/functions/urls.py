"""Product links and identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwatch.functions import fixed as K
from shelfwatch.functions.text import squeeze


def _absolute(url: Column, root: str) -> Column:
    return (
        F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), url)
        .when(url.startswith("//"), F.concat(F.lit(root.split("//")[0]), url))
        .when(url.rlike("^[/?#]"), F.concat(F.lit(root), url))
        .otherwise(F.concat(F.lit(root + "/"), url))
    )


def normalize_url(url: Column, root: str = K.SITE_ROOT) -> Column:
    """Absolute link; a redirect carrying ``url=`` is replaced by its target."""
    absolute = _absolute(url, root)
    target = F.regexp_extract(absolute, r"^[^?#]*\?(?:[^#]*?&)?url=([^&#]+)", 1)
    decoded = F.coalesce(F.try_url_decode(target), target)
    return (
        F.when(url.isNull() | (url == ""), F.lit(""))
        .when(target != "", _absolute(decoded, root))
        .otherwise(absolute)
    )


def canonical_url(asin: Column, root: str = K.SITE_ROOT) -> Column:
    code = F.coalesce(squeeze(asin), F.lit(""))
    return F.when(code == "", F.lit("")).otherwise(
        F.concat(F.lit(root + K.PRODUCT_PATH), code)
    )


def asin_key(asin: Column) -> Column:
    """Upper-case product code; empty if there is none."""
    return F.upper(F.coalesce(squeeze(asin), F.lit("")))


def identity(asin: Column, url: Column, seq: Column) -> Column:
    """Key of a product across batches: code, else link, else the row itself."""
    link = normalize_url(url)
    return (
        F.when(asin_key(asin) != "", F.concat(F.lit("asin:"), asin_key(asin)))
        .when(link != "", F.concat(F.lit("url:"), link))
        .otherwise(F.concat(F.lit("row:"), seq.cast("string")))
    )

"""The given tables seen as product dimension, snapshot facts and raw records.

Money is kept in whole cents until the very end so that every engine agrees to the
last digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions import fixed as K
from shelfwatch.session import dealt, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("long")


def money(cent_count: Column) -> Column:
    """Cents as DECIMAL(10,2)."""
    return (cent_count.cast("decimal(12,0)") / F.lit(100)).cast("decimal(10,2)")


# Discounted cents, half up.
PRICE_CENTS = (
    "(CAST(round(l_extendedprice * 100) AS BIGINT)"
    " * (100 - CAST(round(l_discount * 100) AS BIGINT)) + 50) div 100"
)


def whole(number: Column, by: int) -> Column:
    """Integer division of a whole number >= 0."""
    return ((number - number % by) / by).cast("long")


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_partkey").cast("string").alias("sku"),
        F.col("p_name").alias("title"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("device_type"),
    )


def seller_name(key: Column) -> Column:
    return F.concat(F.lit("Supplier#"), F.lpad(key.cast("string"), 9, "0"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price snapshot per line item; some ratings and discounts are missing."""
    line = table(spark, sf_dir, "lineitem")
    percent = F.round(F.col("l_discount") * 100).cast("long")
    original = cents(F.col("l_extendedprice"))
    return line.select(
        F.col("l_partkey").alias("product_id"),
        money(F.expr(PRICE_CENTS)).alias("price"),
        F.lit(K.CURRENCY).alias("currency"),
        money(original).alias("original_price"),
        F.when(F.col("l_linenumber") != 6, percent).cast("decimal(5,2)").alias("discount_percent"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("long") % 6)
        .cast("decimal(3,2)").alias("rating"),
        F.col("l_linestatus").alias("availability"),
        seller_name(F.col("l_suppkey")).alias("seller"),
        F.col("l_shipdate").cast("date").alias("snapshot_date"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("snapshot_timestamp"),
    )


# Words the raw titles are put together from, so that rules have something to find.
MAKERS = (
    "Samsung", "Acme", "Galaxy", "Lenovo ThinkPad", "hewlett packard", "Xiaomi",
    "generic", "POCO", "(Sony)", "one plus", "Zed",
)
THINGS = (
    "Laptop", "smart phone", "Tab-10", "feature phone", "earbuds", "LED TV", "cable",
    "iPad", "Notebook:", "table", "android tablet", "surface", "with 12",
)
ENDINGS = (
    "for kids", "black, 128GB", "Pro 5", "and the", "up to 20W", " XL  wide ", "- new",
)
STATUSES = (
    "in stock.", "Out of Stock", "Ships in 2 days", "Only 3 left in stock",
    "not available", "membership only",
)


def _pick(words: tuple[str, ...], number: Column) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), (number % len(words)).cast("int"))


def thousands(cent_count: Column) -> Column:
    """Cents as text with thousands commas: 1234567 -> 12,345.67."""
    return F.concat(F.format_number(whole(cent_count, 100), 0), F.lit("."), F.lpad((cent_count % 100).cast("string"), 2, "0"))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scraped record per order; a customer stands for a product.

    Codes differ in case and padding, some are missing, and price, rating, seller and
    status come in the forms the cleaning rules are about.
    """
    order = spread(table(spark, sf_dir, "orders"))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    code = F.concat(F.lit("SKU"), F.lpad(cust.cast("string"), 8, "0"))
    amount = cents(F.col("o_totalprice"))
    status = F.col("o_orderstatus")
    title = F.concat_ws(" ", _pick(MAKERS, cust), _pick(THINGS, key), _pick(ENDINGS, cust + key))
    raw = order.select(
        key.alias("seq"),
        F.when(cust % 13 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 0, F.concat(F.lit(" "), F.lower(code)))
        .otherwise(code).alias("asin"),
        F.when(cust % 26 == 0, F.lit(""))
        .when(cust % 2 == 0, F.concat(F.lit("/dp/"), code))
        .otherwise(F.concat(F.lit("/gp/r?x=1&url=%2Fdp%2F"), code)).alias("product_url"),
        title.alias("title"),
        F.when(status == "F", F.concat(F.lit("EGP "), thousands(amount)))
        .when(status == "O", (amount / 100.0).cast("decimal(12,2)").cast("string"))
        .otherwise(F.lit(None).cast("string")).alias("price"),
        F.when(key % 3 == 0, F.concat(F.lit("Was EGP "), thousands(whole(amount * (80 + key % 7 * 10), 100))))
        .when(key % 3 == 1, F.lit("")).alias("original_price"),
        F.when(key % 4 == 0, F.concat((key % 5).cast("string"), F.lit(".5 out of 5 stars")))
        .when(key % 4 == 1, F.lit("none")).when(key % 4 == 2, F.lit("4,5")).alias("rating"),
        F.lower(F.col("o_orderpriority")).alias("category"),
        F.when(key % 9 == 0, _pick(MAKERS, key)).when(key % 9 == 1, F.lit("Tablet")).alias("brand"),
        F.when(key % 10 == 0, F.lit("Dell Inc")).alias("manufacturer"),
        _pick(STATUSES, key).alias("availability"),
        F.when(key % 6 == 0, F.lit("Unknown Seller"))
        .when(key % 6 == 1, F.concat(F.lit(" Shop "), (cust % 40).cast("string"))).alias("seller"),
        F.when(key % 8 == 0, F.lit("N/A")).when(key % 8 == 1, F.lit(" deep  blue ")).alias("color"),
        F.col("o_orderdate").cast("date").alias("batch_date"),
    )
    return raw


def full_raw(raw: DataFrame) -> DataFrame:
    """Raw records with every column of the raw schema (missing ones null)."""
    return raw.select(
        "seq",
        *[
            F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.RAW_SCHEMA
        ],
    )


def clean_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean-shaped batch with flaws, one row per line item."""
    line = spread(table(spark, sf_dir, "lineitem"))
    n, part = F.col("l_linenumber"), F.col("l_partkey")
    percent = F.round(F.col("l_discount") * 100).cast("long")
    price = F.expr(PRICE_CENTS)
    text = {
        "sku": F.lpad(part.cast("string"), 8, "0"),
        "title": F.concat_ws(" ", _pick(MAKERS, part), _pick(THINGS, part + n)),
        "product_name": F.concat_ws(" ", _pick(MAKERS, part), _pick(THINGS, part)),
        "brand": F.when(part % 17 != 0, _pick(MAKERS, part)),
        "availability": F.when(n != 5, _pick(STATUSES, part)).otherwise(F.lit(K.IN_STOCK)),
        "seller": F.when(n == 1, F.lit(" ")).otherwise(seller_name(F.col("l_suppkey"))),
        "product_url": F.concat(F.lit(K.SITE_ROOT + "/dp/"), part.cast("string")),
        "image_url": F.lit(K.PLACEHOLDER),
        "device_type": F.when(part % 19 != 0, _pick(THINGS, part)),
    }
    for i, name in enumerate(schemas.SPEC_COLUMNS):
        text[name] = F.when(part % (i + 2) == 0, F.lit(K.PLACEHOLDER)).otherwise(
            F.concat(F.lit(name + " "), (part % (5 + i)).cast("string"))
        )
    number = {
        "price": F.when(n != 7, price.cast("double") / 100.0),
        "original_price": (
            cents(F.col("l_extendedprice")) - F.when(n == 2, 5000000).otherwise(0)
        ).cast("double") / 100.0,
        "discount_percent": F.when(n != 6, percent * 11).cast("double"),
        "rating": F.when(n != 4, F.col("l_quantity").cast("long") % 7).cast("double"),
    }
    made = {**text, **number}
    return line.select(*[made[c].alias(c) for c in schemas.CLEAN_COLUMNS])


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail records by code, one per customer; many fields are empty."""
    cust = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    balance = cents(F.abs("c_acctbal"))
    return cust.select(
        F.concat(F.lit("SKU"), F.lpad(key.cast("string"), 8, "0")).alias("asin_key"),
        F.when(key % 3 == 0, F.initcap("c_mktsegment")).otherwise(F.lit("")).alias("brand"),
        F.when(key % 4 == 0, F.col("c_name")).alias("manufacturer"),
        F.when(key % 5 != 0, F.concat(F.lit("shade "), (key % 9).cast("string"))).alias("color"),
        F.when(key % 2 == 0, F.lit("Currently unavailable")).alias("availability"),
        F.when(key % 7 == 0, F.lit("")).otherwise(F.col("c_name")).alias("seller"),
        F.concat(F.lit("EGP "), thousands(balance)).alias("price"),
        F.when(key % 6 == 0, F.concat(F.lit("EGP "), thousands(balance * 2))).alias("original_price"),
    )


def order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension in need of maintenance, one product per order."""
    order = dealt(table(spark, sf_dir, "orders"))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return order.select(
        key.alias("product_id"),
        F.concat(F.lit("SKU"), F.lpad(key.cast("string"), 8, "0")).alias("sku"),
        F.concat_ws(" ", _pick(MAKERS, cust), _pick(THINGS, key), _pick(ENDINGS, cust + key)).alias("title"),
        F.when(key % 5 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 1, F.concat_ws(" ", _pick(MAKERS, cust), _pick(THINGS, key)))
        .when(key % 5 == 2, F.lit(" "))
        .otherwise(F.concat_ws(" ", _pick(MAKERS, cust), _pick(ENDINGS, key))).alias("product_name"),
        F.when(key % 4 == 0, F.lit("unkown seller")).when(key % 4 == 1, _pick(MAKERS, key))
        .when(key % 4 == 2, F.lit("Samsung")).alias("brand"),
        F.when(key % 6 < 3, _pick(("Laptop", "Tablet", "Google pixel", "N/A"), cust)).alias("device_type"),
        F.when(key % 3 == 0, F.lit(" Null ")).when(key % 3 == 1, F.lit("red")).alias("color"),
        F.lit("web").alias("platform"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"),
    )


def line_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load stage with many rows per sku; every second sku is known already."""
    line = table(spark, sf_dir, "lineitem")
    seller = seller_name(F.col("l_suppkey"))
    made = {
        "sku": (F.col("l_partkey") * 2).cast("string"),
        "title": F.concat_ws(" ", F.lit("Offer"), seller),
        "product_name": F.concat_ws(" ", F.lit("Offer"), F.col("l_returnflag")),
        "brand": seller,
        "device_type": F.col("l_linestatus"),
    }
    return line.select(
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag",
                 "l_linestatus").alias("seq"),
        *[made.get(c, F.lit(K.PLACEHOLDER)).alias(c) for c in ("sku", *schemas.DIM_ATTRIBUTES)],
    )


# --- pages derived from tables ------------------------------------------------
def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search result page per order: a full card, one without code, a bare one."""
    order = spread(table(spark, sf_dir, "orders"))
    key, amount = F.col("o_orderkey"), cents(F.col("o_totalprice"))
    k = key.cast("string")
    return order.select(
        key.alias("page_id"),
        F.concat(F.lit(K.SITE_ROOT + "/s?k="), k).alias("url"),
        F.concat(
            F.lit('<html><body><div data-component-type="s-search-result" data-asin="A'), k,
            F.lit('"><img class="s-image" src="/i/'), k,
            F.lit('.jpg"><h2 class="t"><span> Phone &amp; case '), k,
            F.lit('</span></h2><a class="a-link-normal s-no-outline" href="/dp/A'), k,
            F.lit('">x</a><span class="a-badge-text"> Best <b>Seller</b></span><span class="a-price">'
                  '<span class="a-offscreen">EGP '), thousands(amount),
            F.lit('</span></span><span class="a-price a-text-price"><span class="a-offscreen">EGP '),
            thousands(amount * 2),
            F.lit('</span></span><span class="a-icon-alt">4.5 out of 5 stars</span></div>'
                  '<div data-component-type="s-search-result" data-asin=""><h2>No code</h2></div>'
                  '<div data-component-type="s-search-result" data-asin="B'), k,
            F.lit('"><h2>Plain '), F.col("o_orderpriority"), F.lit("</h2><p>unclosed</div>"),
        ).alias("html"),
        F.lower("o_orderpriority").alias("category"),
    )


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product page per part."""
    part = spread(table(spark, sf_dir, "part"))
    key, amount = F.col("p_partkey"), cents(F.col("p_retailprice"))
    k = key.cast("string")
    return part.select(
        key.alias("page_id"),
        F.concat(F.lit(K.SITE_ROOT + "/dp/"), k).alias("url"),
        F.concat(
            F.lit('<html><head><link rel="canonical" href="/x/dp/B0'), F.lpad(k, 8, "0"),
            F.lit('"></head><body><a id="bylineInfo">Visit the '), F.col("p_brand"),
            F.lit(' Store</a><div id="corePrice_feature_div"><span class="a-price priceToPay">'
                  '<span class="a-offscreen">EGP '), thousands(amount),
            F.lit("</span></span>"),
            F.when(key % 2 == 0, F.concat(
                F.lit('<span class="basisPrice"><span class="a-offscreen">EGP '), thousands(amount * 2),
                F.lit("</span></span>"),
            )).otherwise(F.concat(
                F.lit("<div>List Price: <span>EGP "), thousands(amount * 4), F.lit("</span></div>"),
            )),
            F.when(key % 3 == 0, F.lit('<span class="savingsPercentage">-12,5 %</span>')).otherwise(F.lit("")),
            F.lit('</div><table id="productDetails_techSpec_section_1"><tr><th>Item model number'
                  '</th><td> M '), k,
            F.lit('</td></tr><tr><th>Colour</th><td>'), F.col("p_type"),
            F.lit("</td></tr><tr><th>RAM</th><td>"), F.col("p_size").cast("string"),
            F.lit(' GB</td></tr></table><div id="detailBullets_feature_div"><li>Item Weight ‎:‎ '),
            F.col("p_size").cast("string"),
            F.lit(" g</li></div>"),
            F.when(key % 2 == 0, F.lit('<div id="availability"> In stock. </div>'))
            .otherwise(F.concat(F.lit("<p>Only "), k, F.lit(" left in stock - order soon.</p>"))),
            F.when(key % 2 == 0, F.concat(
                F.lit('<div id="merchant-info"><a>Sold by: Shop '), k, F.lit(" and Fulfilled by Amazon</a></div>"),
            )).otherwise(F.concat(F.lit('<script>var s={"sellerName" : "Shop '), k, F.lit(' "}</script>'))),
            F.lit('<div id="feature-bullets"><ul><li><span class="a-list-item">One</span></li><li>'
                  '<span class="a-list-item"> </span></li><li><span class="a-list-item">'),
            F.col("p_name"),
            F.lit('</span></li></ul></div><div id="productDescription"><p>About '), F.col("p_name"),
            F.lit("</p></div>"),
        ).alias("html"),
    )


def listing_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search result pages of other shapes: a price in two parts, redirects, badges of another kind, no rating."""
    order = spread(table(spark, sf_dir, "orders"))
    key, amount = F.col("o_orderkey"), cents(F.col("o_totalprice"))
    k = key.cast("string")
    return order.select(
        key.alias("page_id"),
        F.concat(F.lit(K.SITE_ROOT + "/s?k="), k).alias("url"),
        F.concat(
            F.lit('<!doctype html><div data-component-type="s-search-result" data-asin="V'), k,
            F.lit('"><h2>Two-part '), k, F.lit('</h2><a class="a-link-normal s-no-outline" href="/gp/r?x=1&amp;url=%2Fdp%2FV'), k,
            F.lit('"></a><span class="a-price"><span class="a-price-whole">'), whole(amount, 100).cast("string"),
            F.lit('</span><span class="a-price-fraction">'), F.lpad((amount % 100).cast("string"), 2, "0"),
            F.lit('</span></span><i class="a-text-price"><b class="a-offscreen"></b><b class="a-offscreen">EGP 9</b></i>'
                  '<em class="s-label-popover-default">Ad '), k, F.lit("</em></div>"),
        ).alias("html"),
        F.lit("phone").alias("category"),
    )


def detail_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product pages of four other shapes: where the code, the price and the seller stand."""
    part = spread(table(spark, sf_dir, "part"))
    key, amount = F.col("p_partkey"), cents(F.col("p_retailprice"))
    k = key.cast("string")
    code = F.concat(F.lit("C"), F.lpad(k, 9, "0"))
    scoped = F.concat(F.lit('<div id="buybox"><span id="priceblock_ourprice">EGP '), thousands(amount), F.lit("</span></div>"))
    shapes = (
        F.concat(F.lit('<input id="ASIN" value=" '), code, F.lit(' "><a href="/gp/offer-listing/other"><b class="a-price">EGP 1</b></a>'
                 '<a href="/gp/offer-listing/'), code, F.lit('/ref">New: <span class="a-price">EGP '), thousands(amount), F.lit("</span></a>")),
        F.concat(F.lit('<p data-asin="'), code, F.lit('"></p>'), scoped, F.lit(
            '<div id="offer-display-features"><div offer-display-feature-name="desktop-merchant-info">'
            '<span class="offer-display-feature-text-message">Shown '), k, F.lit("</span></div></div>")),
        F.concat(F.lit('<input name="ASIN" value="'), code, F.lit('">'), scoped, F.lit(
            '<table id="tabular-buybox"><tr><td>Ships from</td><td class="tabular-buybox-text">Depot</td></tr>'
            '<tr><td>Sold by</td><td class="tabular-buybox-text">Box '), k, F.lit("</td></tr></table>")),
        F.concat(F.lit('<input name="asin" value="'), code, F.lit('">'), scoped, F.lit(
            '<div id="merchantInfoFeature_feature_div">Shipper / Seller Zed '), k, F.lit("</div><div>RRP <p>EGP "), thousands(amount * 2), F.lit("</p></div>")),
    )
    return part.select(
        key.alias("page_id"), F.lit("u").alias("url"), F.get(F.array(*shapes), (key % 4).cast("int")).alias("html"),
    )


def shop_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(listing pages, detail pages) of products that the whole job can run on, one per customer."""
    cust = spread(table(spark, sf_dir, "customer"))
    key, amount = F.col("c_custkey"), cents(F.abs("c_acctbal"))
    code = F.concat(F.lit("P"), F.lpad(key.cast("string"), 9, "0"))
    listing = cust.select(
        key.alias("page_id"), F.lit(K.SITE_ROOT + "/s").alias("url"),
        F.concat(
            F.lit('<div data-component-type="s-search-result" data-asin="'), code, F.lit('"><h2>Galaxy phone '), F.col("c_mktsegment"),
            F.lit('</h2><b class="a-price"><i class="a-offscreen">EGP '), thousands(amount), F.lit("</i></b></div>"),
        ).alias("html"),
        F.lit("phone").alias("category"),
    )
    details = cust.select(
        key.alias("page_id"), F.concat(F.lit(K.SITE_ROOT + "/x/dp/"), code).alias("url"),
        F.concat(F.lit('<table id="prodDetails"><tr><th>Color</th><td>shade '), (key % 9).cast("string"), F.lit("</td></tr></table>")).alias("html"),
    )
    return listing, details


def flawed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean batch with blank names, long names and negative prices."""
    number = F.col("sku").cast("long")
    name = F.when(number % 23 == 0, F.lit("  ")).when(number % 29 == 0, F.lit("one two three four five six")).otherwise(F.col("product_name"))
    price = F.when(number % 31 == 0, -F.col("price")).otherwise(F.col("price"))
    return clean_batch(spark, sf_dir).withColumns({"product_name": name, "price": price})

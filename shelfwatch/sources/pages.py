"""Product records from a table of pages.

One Arrow-batched helper turns each page into its marked elements (an array column);
selection order, fallbacks and cleaning are column expressions over that array.  The
whole extraction is one narrow stage: no shuffle, one output row per page or card.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions import fixed as K
from shelfwatch.functions.numbers import clean_price, discount_percent
from shelfwatch.functions.text import let, page_availability, squeeze, strip
from shelfwatch.functions.urls import normalize_url
from shelfwatch.session import dealt
from shelfwatch.sources.outline import Mark, index_marks, outline

# An element: place, last element inside, parent, from and to of its pieces and of its raw pieces.
_NODE = "struct<pre:int,last:int,up:int,a:int,b:int,raw_a:int,raw_b:int,attrs:map<string,string>>"
OUTLINE_SCHEMA = (
    "page_id long, url string, category string, pieces array<string>, raws array<string>, shown int, "
    f"marks map<string,array<{_NODE}>>, labels array<struct<pres:array<int>,a:int,b:int>>, scripts string"
)
_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("category", pa.string()),
        ("pieces", pa.list_(pa.string())), ("raws", pa.list_(pa.string())), ("shown", pa.int32()),
        ("marks", pa.map_(pa.string(), pa.list_(pa.struct([
            *((name, pa.int32()) for name in ("pre", "last", "up", "a", "b", "raw_a", "raw_b")),
            ("attrs", pa.map_(pa.string(), pa.string())),
        ])))),
        ("labels", pa.list_(pa.struct([("pres", pa.list_(pa.int32())), ("a", pa.int32()), ("b", pa.int32())]))),
        ("scripts", pa.string()),
    ]
)
# Pages per output batch; keeps a task's memory to a few pages whatever their size.
_CHUNK = 64

# --- fixed values: where things are on a page --------------------------------
LISTING_MARKS = {
    "card": (Mark(tags=("div",), attrs=(("data-component-type", "s-search-result"),)),),
    "title": (Mark(tags=("h2",), below="card"),),
    "title span": (Mark(tags=("span",), below="title"),),
    "price box": (Mark(classes=("a-price",), below="card"),),
    "price": (Mark(classes=("a-offscreen",), below="price box"),),
    "price whole": (Mark(tags=("span",), classes=("a-price-whole",), below="card"),),
    "price fraction": (Mark(tags=("span",), classes=("a-price-fraction",), below="card"),),
    "strike box": (Mark(classes=("a-text-price",), below="card"),),
    "strike price": (Mark(classes=("a-offscreen",), below="strike box"),),
    "rating": (Mark(tags=("span",), classes=("a-icon-alt",), below="card"),),
    "image": (Mark(tags=("img",), classes=("s-image",), below="card"),),
    "link": (Mark(tags=("a",), exact_class="a-link-normal s-no-outline", below="card"),),
    "badge": (
        Mark(classes=("a-badge-text",), below="card"),
        Mark(classes=("s-label-popover-default",), below="card"),
    ),
}

_PRICE_SCOPES = (
    "corePriceDisplay_desktop_feature_div", "corePriceDisplay_mobile_feature_div",
    "corePrice_feature_div", "apex_desktop", "apex_mobile", "buybox",
)
_SPEC_SCOPES = (
    "productOverview_feature_div", "productDetails_techSpec_section_1",
    "productDetails_detailBullets_sections1", "prodDetails",
)
_ARIA = (("aria-hidden", "true"),)
DETAIL_MARKS = {
    # prices
    "price scope": tuple(Mark(id=i) for i in _PRICE_SCOPES),
    "to pay box": (Mark(classes=("priceToPay",)),),
    "to pay 1": (Mark(classes=("a-offscreen",), below="to pay box"),),
    "to pay 2": (Mark(attrs=_ARIA, below="to pay box"),),
    "price box": (Mark(classes=("a-price",)),),
    "to pay 3": (Mark(classes=("a-offscreen",), below="price box"),),
    "to pay 4": (Mark(id="priceblock_dealprice"),),
    "to pay 5": (Mark(id="priceblock_ourprice"),),
    "basis box": (Mark(classes=("basisPrice",)),),
    "strike 1": (Mark(classes=("a-offscreen",), below="basis box"),),
    "strike 2": (Mark(attrs=_ARIA, below="basis box"),),
    "struck price box": (Mark(classes=("a-price", "a-text-price")),),
    "strike 3": (Mark(classes=("a-offscreen",), below="struck price box"),),
    "strike 4": (Mark(attrs=_ARIA, below="struck price box"),),
    "text price box": (Mark(classes=("a-text-price",)),),
    "strike 5": (Mark(classes=("a-offscreen",), below="text price box"),),
    "strike 6": (Mark(attrs=_ARIA, below="text price box"),),
    "strike flag box": (Mark(attrs=(("data-a-strike", "true"),)),),
    "strike 7": (Mark(classes=("a-offscreen",), below="strike flag box"),),
    "strike 8": (Mark(attrs=_ARIA, below="strike flag box"),),
    "strike 9": (Mark(id="listPrice"),),
    "savings 1": (Mark(classes=("savingsPercentage",)),),
    "savings box": (Mark(id="regularprice_savings"),),
    "savings 2": (Mark(classes=("a-color-price",), below="savings box"),),
    "offer link": (Mark(tags=("a",), holds=(("href", "offer-listing/"),)),),
    "offer price": (
        Mark(classes=("a-offscreen",), below="price box"),
        Mark(attrs=_ARIA, below="price box"),
        Mark(classes=("a-price",)),
    ),
    # product code
    "code 1": (Mark(tags=("input",), id="ASIN"),),
    "code 2": (Mark(tags=("input",), attrs=(("name", "ASIN"),)),),
    "code 3": (Mark(tags=("input",), attrs=(("name", "asin"),)),),
    "code 4": (Mark(attrs=(("data-asin", None),)),),
    "canonical": (Mark(tags=("link",), attrs=(("rel", "canonical"),)),),
    # specs and texts
    "spec scope": tuple(Mark(id=i) for i in _SPEC_SCOPES),
    "spec row": (Mark(tags=("tr",), below="spec scope"),),
    "spec cell": (Mark(tags=("th", "td"), below="spec row"),),
    "spec list": (Mark(id="detailBullets_feature_div"),),
    "spec bullet": (Mark(tags=("li",), below="spec list"),),
    "byline": (Mark(id="bylineInfo"),),
    "description": (Mark(id="productDescription"),),
    "feature list": (Mark(id="feature-bullets"),),
    "feature item": (Mark(tags=("li",), below="feature list"),),
    "feature": (Mark(tags=("span",), classes=("a-list-item",), below="feature item"),),
    # availability
    "stock 1": (Mark(id="availability"),),
    "stock 2": (Mark(id="availabilityInsideBuyBox_feature_div"),),
    "stock 3": (Mark(id="outOfStock"),),
    "buybox": (Mark(id="buybox"),),
    "stock 4": (Mark(classes=("a-color-success",), below="buybox"),),
    "stock 5": (Mark(classes=("a-color-state",), below="buybox"),),
    # seller
    "merchant box": (Mark(id="merchantInfoFeature_feature_div"),),
    "offer features": (Mark(id="offer-display-features"),),
    "merchant feature": (Mark(attrs=(("data-feature-name", "merchantInfoFeature"),)),),
    "merchant desktop": (Mark(attrs=(("offer-display-feature-name", "desktop-merchant-info"),)),),
    "offered merchant feature": (
        Mark(attrs=(("data-feature-name", "merchantInfoFeature"),), below="offer features"),
    ),
    "offered merchant desktop": (
        Mark(attrs=(("offer-display-feature-name", "desktop-merchant-info"),), below="offer features"),
    ),
    "offered merchant content": (
        Mark(attrs=(("data-csa-c-content-id", "desktop-merchant-info"),), below="offer features"),
    ),
    "source merchant box": (Mark(id="sourceMerchantInfoFeature_feature_div"),),
    "dynamic merchant box": (Mark(id="dynamicSourceMerchantInfoFeature_feature_div"),),
    "merchant info": (Mark(id="merchant-info"),),
    "seller 1": (Mark(id="sellerProfileTriggerId"),),
    "seller 2": (Mark(classes=("offer-display-feature-text-message",), below="merchant box"),),
    "seller 3": (
        Mark(classes=("offer-display-feature-text-message",), below="offered merchant feature"),
    ),
    "seller 4": (Mark(tags=("a",), below="merchant info"),),
    "shown 2": (Mark(classes=("odf-popover-overflow-wrap",), below="merchant box"),),
    "shown 4": (
        Mark(classes=("offer-display-feature-text-message",), below="offered merchant desktop"),
    ),
    "shown 5": (
        Mark(classes=("offer-display-feature-text-message",), below="offered merchant content"),
    ),
    "shown 6": (Mark(classes=("offer-display-feature-text-message",), below="source merchant box"),),
    "shown 7": (Mark(classes=("offer-display-feature-text-message",), below="dynamic merchant box"),),
    "tabular": (Mark(id="tabular-buybox"),),
    "tabular row": (
        Mark(tags=("tr",), below="tabular"),
        Mark(classes=("tabular-buybox-container",), below="tabular"),
    ),
    "tabular link": (Mark(tags=("a",), below="tabular row"),),
    "tabular value": (
        Mark(classes=("tabular-buybox-text",), below="tabular row"),
        Mark(classes=("a-column",), last_child=True, below="tabular row"),
    ),
}
PRICE_LABEL = r"\b(List Price|Was|RRP)\b"
LABEL_MARKS = (
    Mark(attrs=_ARIA), Mark(classes=("a-offscreen",)), Mark(classes=("a-price",)), Mark(tags=("span",)),
)
ATTRIBUTES = ("data-asin", "value", "href", "src")
# Plain article pages: heading, links, paragraphs, advertisement.
ARTICLE_MARKS = {
    "title": (Mark(tags=("title",)),),
    "heading": (Mark(tags=("h1",)),),
    "menu": (Mark(tags=("nav",)),),
    "link": (Mark(tags=("a",), below="menu"),),
    "article": (Mark(tags=("article",)),),
    "paragraph": (Mark(tags=("p",), below="article"),),
    "ad": (Mark(tags=("div",), classes=("ad",)),),
    "foot": (Mark(tags=("footer",)),),
}


def drop_blocked(pages: DataFrame) -> DataFrame:
    """Pages without a sign of a robot check (decided before any parsing)."""
    return pages.where(~is_blocked(F.col("html")))


def is_blocked(html: Column) -> Column:
    def holds_marker(low: Column) -> Column:
        found = F.lit(False)
        for marker in K.BLOCKED_MARKERS:
            found = found | low.contains(marker)
        return found

    # Made lower case once, not for each marker.
    return let(F.lower(F.coalesce(html, F.lit(""))), holds_marker)


def outlines(pages: DataFrame, marks: dict, label: str | None = None, raw: bool = False) -> DataFrame:
    """Marked elements per page; see ``OUTLINE_SCHEMA``.  ``raw``: with the pieces' white space.

    Pages that ``drop_blocked`` drops are left out.  The test goes along as a column: a filter would
    move ahead of where rows are dealt to tasks, and pages be made there and once more behind it.
    """
    if "category" not in pages.columns:
        pages = pages.withColumn("category", F.lit(None).cast("string"))
    pattern = re.compile(label, re.I) if label else None
    index = index_marks(marks)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("passed"))
            for start in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(start, _CHUNK)
                found = [
                    outline(html, index, ATTRIBUTES, pattern, LABEL_MARKS)
                    for html in part.column("html").to_pylist()
                ]
                columns = {c: part.column(c) for c in ("page_id", "url", "category")}
                for field in list(_ARROW)[3:]:
                    values = [f[field.name] if raw or field.name != "raws" else [] for f in found]
                    columns[field.name] = pa.array(values, field.type)
                yield pa.RecordBatch.from_pydict(columns, schema=_ARROW)

    wanted = dealt(pages.select("page_id", "url", "category", "html", (~is_blocked(F.col("html"))).alias("passed")))
    return wanted.mapInArrow(read, OUTLINE_SCHEMA)


# --- expressions over a page's elements -----------------------------------------
# ``marks`` has the elements of each mark, ``pieces`` and ``raws`` the page's text.  A mark's
# elements are found by the mark's name: no lookup reads those of others.
def _all(mark: str) -> Column:
    return F.coalesce(F.col("marks")[mark], F.array())


def _get(values: Column) -> Column:
    return F.get(values, F.lit(0))


def _node(mark: str, test: Callable[[Column], Column] | None = None) -> Column:
    """The first element of a mark (that passes); null if there is none."""
    return _get(F.filter(_all(mark), test) if test else F.col("marks")[mark])


def _below(outer: Column) -> Callable[[Column], Column]:
    return lambda n: (n["pre"] > outer["pre"]) & (n["pre"] <= outer["last"])


def _text(node: Column) -> Column:
    """An element's text, white space squeezed; null if there is no element."""
    return F.array_join(F.slice("pieces", node["a"] + 1, node["b"] - node["a"]), " ")


def _raw(node: Column) -> Column:
    """An element's text as it stands, but for its edges."""
    return strip(F.array_join(F.slice("raws", node["raw_a"] + 1, node["raw_b"] - node["raw_a"]), ""))


def _price(node: Column) -> Column:
    return clean_price(_text(node))


def _first(
    marks: tuple[str, ...], value: Callable[[Column], Column], keep: Callable[[Column], Column],
    test: Callable[[Column], Column] | None = None,
) -> Column:
    """The first value to keep, of the first mark that has one, among elements that pass."""
    found = []
    for mark in marks:
        nodes = F.filter(_all(mark), test) if test else _all(mark)
        found.append(_get(F.filter(F.transform(nodes, value), keep)))
    return F.coalesce(*found)


def _some(value: Column) -> Column:
    return value != ""


def _first_text(*marks: str, test: Callable[[Column], Column] | None = None) -> Column:
    return _first(marks, _text, _some, test)


def _first_price(marks: tuple[str, ...], test: Callable[[Column], Column] | None = None) -> Column:
    return _first(marks, _price, F.isnotnull, test)


def _numbered(stem: str, last: int) -> tuple[str, ...]:
    return tuple(f"{stem} {i}" for i in range(1, last + 1))


def clean_seller(col: Column) -> Column:
    """Seller name without labels, fulfilment notes and doubling."""
    name = squeeze(col)
    for pattern in K.SELLER_NOISE:
        name = F.regexp_replace(name, pattern, "")
    # "A B A B" reads "A B": the text equals its first half, a blank, and it again.
    half = F.regexp_replace(squeeze(name), r"^(.+) \1\z", "$1")
    return let(
        half,
        lambda h: F.when(h.isNull(), F.lit(""))
        .when(F.lower(h).isin(*K.HOUSE_SELLER_FORMS), F.lit(K.HOUSE_SELLER)).otherwise(h),
    )


def spec_map() -> Column:
    """Spec table rows and "key: value" bullets; a later key replaces an earlier one."""
    def row_pair(row: Column) -> Column:
        cells = F.filter(_all("spec cell"), _below(row))
        key = _get(cells)
        value = _get(F.filter(cells, lambda c: (c["up"] == key["up"]) & (c["pre"] > key["last"])))
        return F.struct(_text(key).alias("key"), _text(value).alias("value"))

    def side(s: Column) -> Column:
        return squeeze(F.replace(s, F.lit("\u200e"), F.lit("")))

    def bullet_pair(node: Column) -> Column:
        text = _text(node)
        colon = F.instr(text, ":")
        return F.struct(
            F.when(colon > 0, side(F.substring_index(text, ":", 1))).alias("key"),
            F.when(colon > 0, side(F.substr(text, colon + 1))).alias("value"),
        )

    pairs = F.concat(F.transform(_all("spec row"), row_pair), F.transform(_all("spec bullet"), bullet_pair))
    return F.map_from_entries(F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != "")))


def spec_entries(specs: Column) -> Column:
    """Specs as (plain key, value): lower case, other signs as single blanks.

    Keys that read alike become one, placed where the first was, with the last value.
    """
    plain = F.transform(
        F.map_entries(specs),
        lambda e: F.struct(
            F.trim(F.regexp_replace(F.lower(e["key"]), "[^a-z0-9]+", " ")).alias("k"),
            e["value"].alias("v"),
        ),
    )

    def merged(entries: Column) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
        return F.transform(
            keys,
            lambda k: F.get(F.reverse(F.filter(entries, lambda e: e["k"] == k)), F.lit(0)),
        )

    return let(plain, merged)


def get_spec(entries: str, labels: tuple[str, ...]) -> Column:
    """Value of the first spec whose key contains a label, in label order; else empty."""
    picks = [f"get(filter({entries}, e -> contains(e.k, '{label}')), 0).v" for label in labels]
    return F.expr(f"coalesce({', '.join(picks)}, '')")


def page_code() -> Column:
    """Product code of a page from its inputs, attributes or canonical link."""
    def of(mark: str) -> Column:
        attrs = _node(mark)["attrs"]
        code = F.coalesce(F.nullif(attrs["value"], F.lit("")), attrs["data-asin"])
        return F.nullif(squeeze(code), F.lit(""))

    href = _node("canonical")["attrs"]["href"]
    return F.coalesce(
        *[of(f"code {i}") for i in range(1, 5)], F.regexp_extract(href, K.PAGE_CODE, 1), F.lit("")
    )


def _offer_price(code: Column) -> Column:
    """First price in or below a link to the page's other offers."""
    def among(path: str) -> Column:
        links = F.filter(_all("offer link"), lambda n: F.contains(n["attrs"]["href"], F.concat(F.lit(path), code)))
        prices = F.transform(links, lambda a: F.coalesce(_first_price(("offer price",), _below(a)), _price(a)))
        return _get(F.filter(prices, F.isnotnull))

    return F.when(code != "", F.coalesce(among("/offer-listing/"), among("offer-listing/")))


def _labelled_price(scope: Column | None = None) -> Column:
    """The price near the first label that has one: on the page, or inside ``scope`` by the labels' places there."""
    labels = F.col("labels")
    if scope is not None:
        inside = F.transform(labels, lambda l: F.struct(
            F.array_min(F.filter(l["pres"], lambda p: (p >= scope["pre"]) & (p <= scope["last"]))).alias("pre"),
            l["a"].alias("a"), l["b"].alias("b"),
        ))
        labels = F.array_sort(F.filter(inside, lambda l: l["pre"].isNotNull()))
    return _get(F.filter(F.transform(labels, _price), F.isnotnull))


def _seller() -> Column:
    """Seller from the buy box, the offer display, the tabular box or script data."""
    def seller(node: Column) -> Column:
        return clean_seller(_text(node))

    # The first element with any text decides, even if cleaning leaves nothing of it.
    plain = clean_seller(_first_text(*_numbered("seller", 4), "merchant info"))
    shown = _first(("seller 2", "shown 2", "seller 3", "shown 4", "shown 5", "shown 6", "shown 7"), seller, _some)
    boxes = F.array_sort(F.concat(*[
        F.transform(_all(m), lambda n: F.struct(n["pre"].alias("pre"), n["a"].alias("a"), n["b"].alias("b")))
        for m in ("merchant box", "merchant feature", "merchant desktop")
    ]))
    boxed = _get(F.filter(
        F.transform(F.filter(boxes, lambda n: _text(n).rlike(r"(?i)shipper\s*/\s*seller|seller")), seller), _some
    ))

    def of_row(row: Column) -> Column:
        def inside(mark: str) -> Column:
            return F.nullif(seller(_node(mark, _below(row))), F.lit(""))

        own = seller(row)
        return F.coalesce(
            F.when(_node("tabular link", _below(row)).isNotNull(), inside("tabular link")),
            F.when(_node("tabular value", _below(row)).isNotNull(), inside("tabular value")),
            F.when((own != "") & ~own.rlike(r"(?i)^(sold by|seller)\z"), own),
        )

    rows = F.filter(_all("tabular row"), lambda r: _text(r).rlike("(?i)sold by|seller"))
    tabular = _get(F.filter(F.transform(rows, of_row), F.isnotnull))

    def of_key(key: str) -> Column:
        raw = F.nullif(F.regexp_extract("scripts", rf'"{key}"\s*:\s*"([^"]+)"', 1), F.lit(""))
        read = F.from_json(F.concat(F.lit('["'), raw, F.lit('"]')), "array<string>")
        return F.coalesce(F.get(read, F.lit(0)), raw)

    scripted = F.filter(
        F.transform(F.array(*[of_key(k) for k in K.SELLER_KEYS]), clean_seller), lambda s: s != ""
    )
    return F.coalesce(F.nullif(plain, F.lit("")), shown, boxed, tabular, _get(scripted), F.lit(""))


def extract_listings(pages: DataFrame) -> DataFrame:
    """Search result cards to raw records; cards without a code are skipped.

    ``position`` is the card's place on its page.  Records are made before cards become
    rows, so that no row carries a page.
    """
    def record(card: Column, position: Column) -> Column:
        inside = _below(card)
        heading, image = _node("title", inside), _node("image", inside)
        in_parts = F.concat(
            _raw(_node("price whole", inside)),
            F.coalesce(F.concat(F.lit("."), _raw(_node("price fraction", inside))), F.lit("")),
        )
        shown = F.coalesce(
            F.nullif(_text(_node("price", inside)), F.lit("")), F.nullif(in_parts, F.lit("")), F.lit("")
        )
        return let(shown, lambda price: F.struct(
            position.cast("long").alias("position"),
            card["attrs"]["data-asin"].alias("asin"),
            F.coalesce(_raw(_node("title span", _below(heading))), _raw(heading), F.lit(K.NO_TITLE)).alias("title"),
            F.when(price == "", F.lit(K.NO_PRICE)).otherwise(price).alias("price"),
            F.coalesce(
                _first(("strike price",), _text, lambda t: (t != "") & (t != price), inside), F.lit("")
            ).alias("original_price"),
            F.coalesce(_raw(_node("rating", inside)), F.lit(K.NO_RATING)).alias("rating"),
            F.when(image.isNull(), F.lit("")).otherwise(image["attrs"]["src"]).alias("image_url"),
            normalize_url(_node("link", inside)["attrs"]["href"]).alias("product_url"),
            F.filter(F.transform(F.filter(_all("badge"), inside), _text), _some).alias("listing_badges"),
        ))

    records = F.filter(F.transform(_all("card"), record), lambda r: F.coalesce(r["asin"], F.lit("")) != "")
    return (
        outlines(pages, LISTING_MARKS, raw=True)
        .select("page_id", "category", F.explode(records).alias("r"))
        .select(
            "page_id", *[f"r.{c}" for c in ("position", "asin", "title", "price", "original_price", "rating", "image_url", "product_url")],
            "category", F.col("category").alias("source_search_term"), "r.listing_badges",
        )
    )


def extract_details(pages: DataFrame) -> DataFrame:
    """Product pages to detail records, one row per page, with the page's code."""
    read = (
        outlines(pages, DETAIL_MARKS, PRICE_LABEL)
        .withColumns({"scope": _node("price scope"), "page_code": page_code(), "product_specs": spec_map()})
        .withColumn("entries", spec_entries(F.col("product_specs")))
    )
    scope = F.col("scope")

    def near(n: Column) -> Column:
        return scope.isNull() | _below(scope)(n)

    price = F.coalesce(_first_price(_numbered("to pay", 5), near), _offer_price(F.col("page_code")))
    original = F.coalesce(
        _first_price(_numbered("strike", 9), near),
        F.when(scope.isNotNull(), _labelled_price(scope)), _labelled_price(),
    )
    savings = F.coalesce(_first_text("savings 1", "savings 2", test=near), _first_text("savings 1"))
    percent = F.replace(
        F.regexp_extract(savings, r"(\d+(?:[.,]\d+)?)\s*%", 1), F.lit(","), F.lit(".")
    ).try_cast("double")
    priced = read.withColumns({"_price": price, "_original": original, "_percent": percent})
    page_text = F.array_join(F.slice("pieces", F.lit(1), F.col("shown")), " ")
    stock = F.coalesce(
        _first_text(*_numbered("stock", 5)),
        *[F.nullif(F.regexp_extract(page_text, p, 1), F.lit("")) for p in K.STOCK_PATTERNS],
    )
    brand_line = F.replace(
        F.regexp_replace(_text(_node("byline")), r"(?i)^(visit the|brand:|store:)\s+", ""),
        F.lit(" Store"), F.lit(""),
    )
    looked_up = {name: get_spec("entries", found) for name, found in K.SPEC_LABELS.items()}
    looked_up["brand"] = F.coalesce(F.nullif(looked_up["brand"], F.lit("")), brand_line, F.lit(""))
    columns = {
        **looked_up,
        "availability": F.coalesce(page_availability(stock), F.lit("")),
        "seller": _seller(),
        "price": F.col("_price").cast("string"),
        "original_price": F.col("_original").cast("string"),
        "discount_percent": F.coalesce(
            F.col("_percent"), discount_percent(F.col("_price"), F.col("_original"))
        ).cast("string"),
        "product_description": F.coalesce(_text(_node("description")), F.lit("")),
        "bullet_points": F.slice(F.filter(F.transform(_all("feature"), _text), _some), 1, K.MAX_BULLETS),
        "product_specs": F.col("product_specs"),
    }
    return priced.select(
        "page_id", "url", "page_code",
        *[columns[name].alias(name) for name in schemas.DETAIL_FIELDS],
    )


def extract_articles(pages: DataFrame) -> DataFrame:
    """Article pages: title, heading, menu links, paragraph count, advertisement."""
    def text(mark: str) -> Column:
        return F.coalesce(_text(_node(mark)), F.lit(""))

    return outlines(pages, ARTICLE_MARKS).select(
        "page_id",
        text("title").alias("title"),
        text("heading").alias("heading"),
        F.size(_all("link")).cast("long").alias("n_links"),
        _node("link")["attrs"]["href"].alias("first_link"),
        F.size(_all("paragraph")).cast("long").alias("n_paragraphs"),
        text("ad").alias("ad"),
        text("foot").alias("foot"),
    )

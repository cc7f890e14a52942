"""The registered queries in plain SQL, as an independent check.

Written for an engine without lookaround and without the Spark functions used by the
queries: rules become CASE chains, folds become window functions, ids and percentiles
are taken over whole sorted tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from shelfwatch import schemas
from shelfwatch.functions import fixed as K
from shelfwatch.plans import views
from shelfwatch.plans.queries import HIGH_DISCOUNT, MERGED, PERIODS

SP, NW, ND = K.SPACE, K.NOT_WORD, K.DIGIT
LOAD = "2024-01-01 12:00:00"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def some(values: Sequence[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def pick(words: Sequence[str], number: str) -> str:
    return f"([{', '.join(q(w) for w in words)}])[CAST(({number}) % {len(words)} AS INTEGER) + 1]"


# --- scalar rules ----------------------------------------------------------------
def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(SP + '+')}, ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{SP}+|{SP}+$')}, '', 'g')"


def clean_text(x: str) -> str:
    return f"nullif({squeeze(x)}, '')"


def missing(x: str) -> str:
    return f"coalesce(lower({squeeze(x)}) IN {some(K.CLEAN_MISSING)}, true)"


def or_placeholder(x: str) -> str:
    return f"CASE WHEN {missing(x)} THEN {q(K.PLACEHOLDER)} ELSE {x} END"


def shipping(x: str) -> str:
    words = "|".join(K.SHIPPING_WORDS)
    return f"coalesce(regexp_matches({x}, {q(f'(?i)(^|{NW})({words})($|{NW})')}), false)"


def letters(x: str) -> str:
    return f"regexp_replace(lower({x}), '[^a-z]+', '', 'g')"


def availability(x: str) -> str:
    t = clean_text(x)
    return (
        f"CASE WHEN {t} IS NULL OR {shipping(t)} THEN {q(K.PLACEHOLDER)}"
        f" WHEN {letters(t)} IN {some(K.IN_STOCK_FORMS)} THEN {q(K.IN_STOCK)}"
        f" WHEN {letters(t)} IN {some(K.OUT_OF_STOCK_FORMS)} THEN {q(K.OUT_OF_STOCK)}"
        f" WHEN lower({t}) IN {some(K.CLEAN_MISSING)} THEN {q(K.PLACEHOLDER)} ELSE {t} END"
    )


def page_availability(x: str) -> str:
    t = squeeze(x)
    return (
        f"CASE WHEN {t} IS NULL OR {shipping(t)} THEN ''"
        f" WHEN {letters(t)} IN {some(K.IN_STOCK_FORMS)} THEN {q(K.IN_STOCK)}"
        f" WHEN {letters(t)} IN {some(K.OUT_OF_STOCK_FORMS)} THEN {q(K.OUT_OF_STOCK)} ELSE {t} END"
    )


def capitalize(x: str) -> str:
    return f"upper(substr({x}, 1, 1)) || lower(substr({x}, 2))"


def price(x: str) -> str:
    n = f"replace(regexp_extract({x}, {q(f'[{ND},.]+')}), ',', '')"
    bare = f"replace({n}, '.', '')"
    return f"TRY_CAST(CASE WHEN length({n}) - length({bare}) > 1 THEN {bare} ELSE {n} END AS DOUBLE)"


def rating(x: str) -> str:
    return f"TRY_CAST(regexp_extract({x}, {q(f'[{ND}.]+')}) AS DOUBLE)"


def cents(x: str) -> str:
    return f"CAST(ROUND(({x}) * 100) AS BIGINT)"


def discount(p: str, o: str) -> str:
    return (
        f"CASE WHEN {o} > 0 AND {p} <= {o} THEN CAST((2 * ({cents(o)} - {cents(p)}) * 10000 + {cents(o)})"
        f" // (2 * {cents(o)}) AS BIGINT) / 100.0 END"
    )


def words(x: str) -> str:
    return (
        f"CASE WHEN {clean_text(x)} IS NULL THEN 0"
        f" ELSE CAST(len(string_split({squeeze(x)}, ' ')) AS BIGINT) END"
    )


def noise_word(w: str) -> str:
    return (
        f"(lower({w}) IN {some(K.NAME_TRAILING_WORDS)}"
        f" OR regexp_full_match({w}, {q(f'{ND}+([.,]{ND}+)?')}))"
    )


def trailing_noise(x: str) -> str:
    last = f"string_split({squeeze(x)}, ' ')[-1]"
    return f"coalesce({clean_text(x)} IS NOT NULL AND {noise_word(last)}, false)"


def bad_name(x: str) -> str:
    return (
        f"({clean_text(x)} IS NULL OR {trailing_noise(x)} OR {words(x)} > {K.NAME_MAX_WORDS})"
    )


def first_class(x: str, rules: Mapping[str, Sequence[str]]) -> str:
    arms = " ".join(
        f"WHEN regexp_matches({x}, {q('(^|[^a-z0-9])(' + '|'.join(terms) + ')($|[^a-z0-9])')}) THEN {q(name)}"
        for name, terms in rules.items()
    )
    return f"CASE {arms} END"


def any_class(x: str, rules: Mapping[str, Sequence[str]]) -> str:
    terms = "|".join(t for ts in rules.values() for t in ts)
    return f"regexp_matches({x}, {q(f'(^|[^a-z0-9])({terms})($|[^a-z0-9])')})"


def low(x: str) -> str:
    return f"lower(coalesce({squeeze(x)}, ''))"


def device(title: str, category: str) -> str:
    return first_class(low(f"coalesce({title}, '') || ' ' || coalesce({category}, '')"), K.DEVICE_TERMS)


def brand(title: str, scraped: str, maker: str) -> str:
    return "coalesce(" + ", ".join(
        first_class(low(x), K.BRAND_TERMS) for x in (scraped, maker, title)
    ) + ")"


def right_brand(title: str, scraped: str, maker: str, dev: str) -> str:
    s = squeeze(scraped)
    return (
        f"coalesce({brand(title, scraped, maker)}, CASE WHEN lower({s}) IN {some(K.GENERIC_BRANDS)}"
        f" OR {any_class(low(scraped), K.DEVICE_TERMS)} OR coalesce(lower({s}) = lower({dev}), false)"
        f" THEN NULL ELSE {s} END)"
    )


def name_ctes(source: str, key: str, title: str, out: str) -> str:
    """CTE ``out`` (key, product_name) for titles of ``source``.

    Instead of a walk over the words: the first word kept, the first break at or after
    it, the first five kept words before that, cut after the last one that may end a name.
    """
    p = out
    return f"""
    {p}_t AS (SELECT {key} AS k, unnest(parts) AS tok, generate_subscripts(parts, 1) AS i
        FROM (SELECT {key}, regexp_split_to_array({title}, {q(SP + '+')}) AS parts FROM {source})),
    {p}_w AS (SELECT k, i, regexp_matches(tok, '[,:\\-_]') AS sep,
        regexp_replace(regexp_extract(tok, '^[^,:\\-_]*'), {q(f'^{NW}+|{NW}+$')}, '', 'g') AS word FROM {p}_t),
    {p}_n AS (SELECT *, {noise_word('word')} AS noise,
        NOT sep AND lower(word) IN {some(K.NAME_BREAK_WORDS)} AS brk FROM {p}_w),
    {p}_c AS (SELECT *, word <> '' AND CASE WHEN sep THEN NOT noise ELSE NOT brk END AS keep FROM {p}_n),
    {p}_f AS (SELECT *, min(CASE WHEN keep THEN i END) OVER (PARTITION BY k) AS head FROM {p}_c),
    {p}_b AS (SELECT *, min(CASE WHEN (sep AND i >= head) OR (brk AND i > head) THEN i END)
        OVER (PARTITION BY k) AS stop FROM {p}_f),
    {p}_p AS (SELECT k, i, word, noise, row_number() OVER (PARTITION BY k ORDER BY i) AS pos
        FROM {p}_b WHERE keep AND (stop IS NULL OR i <= stop)),
    {p}_l AS (SELECT k, max(pos) AS tail FROM {p}_p WHERE pos <= {K.NAME_MAX_WORDS} AND NOT noise GROUP BY k),
    {p} AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS product_name
        FROM {p}_p JOIN {p}_l USING (k) WHERE pos <= tail AND pos <= {K.NAME_MAX_WORDS} GROUP BY k)"""


# --- the tables as the queries see them --------------------------------------------
DIM = """dim AS (SELECT p_partkey AS product_id, CAST(p_partkey AS VARCHAR) AS sku, p_name AS title,
    p_name AS product_name, p_brand AS brand, p_type AS device_type FROM part)"""

_LINE = """(SELECT *, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS oc,
    CAST(ROUND(l_discount * 100) AS BIGINT) AS pct FROM lineitem)"""
PC = "CAST((oc * (100 - pct) + 50) // 100 AS BIGINT)"

FACT = f"""fact AS (SELECT l_partkey AS product_id, oc, {PC} AS pc,
    CASE WHEN l_linenumber <> 6 THEN pct END AS d,
    CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) % 6 END AS r,
    l_linestatus AS availability, s_name AS seller, l_shipdate AS seen
    FROM {_LINE} JOIN supplier ON s_suppkey = l_suppkey)"""
BOTH = f"{DIM}, {FACT}, j AS (SELECT * FROM fact JOIN dim USING (product_id))"


def thousands(c: str) -> str:
    return f"(format('{{:,}}', ({c}) // 100) || '.' || lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0'))"


_TITLE = (
    f"concat_ws(' ', {pick(views.MAKERS, 'o_custkey')}, {pick(views.THINGS, 'o_orderkey')},"
    f" {pick(views.ENDINGS, 'o_custkey + o_orderkey')})"
)
RAW = f"""raw AS (SELECT o_orderkey AS seq,
    CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN ' ' || lower(code) ELSE code END AS asin,
    CASE WHEN o_custkey % 26 = 0 THEN '' WHEN o_custkey % 2 = 0 THEN '/dp/' || code
        ELSE '/gp/r?x=1&url=%2Fdp%2F' || code END AS product_url,
    {_TITLE} AS title,
    CASE o_orderstatus WHEN 'F' THEN 'EGP ' || {thousands('amount')}
        WHEN 'O' THEN (amount // 100) || '.' || lpad(CAST(amount % 100 AS VARCHAR), 2, '0') END AS price,
    CASE o_orderkey % 3 WHEN 0 THEN 'Was EGP ' || {thousands('(amount * (80 + o_orderkey % 7 * 10)) // 100')}
        WHEN 1 THEN '' END AS original_price,
    CASE o_orderkey % 4 WHEN 0 THEN (o_orderkey % 5) || '.5 out of 5 stars' WHEN 1 THEN 'none'
        WHEN 2 THEN '4,5' END AS rating,
    lower(o_orderpriority) AS category,
    CASE o_orderkey % 9 WHEN 0 THEN {pick(views.MAKERS, 'o_orderkey')} WHEN 1 THEN 'Tablet' END AS brand,
    CASE WHEN o_orderkey % 10 = 0 THEN 'Dell Inc' END AS manufacturer,
    {pick(views.STATUSES, 'o_orderkey')} AS availability,
    CASE o_orderkey % 6 WHEN 0 THEN 'Unknown Seller' WHEN 1 THEN ' Shop ' || (o_custkey % 40) END AS seller,
    CASE o_orderkey % 8 WHEN 0 THEN 'N/A' WHEN 1 THEN ' deep  blue ' END AS color,
    CAST(o_orderdate AS DATE) AS batch_date
    FROM (SELECT *, 'SKU' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS code,
        CAST(ROUND(o_totalprice * 100) AS BIGINT) AS amount FROM orders))"""

_P, _O = price("price"), price("original_price")
SCORED = f"""priced AS (SELECT * REPLACE ({_P} AS price, {_O} AS original_price, {rating('rating')} AS rating),
        coalesce({device('title', 'category')}, {clean_text(capitalize('category'))}) AS device_type FROM raw),
    scored AS (SELECT * REPLACE ({right_brand('title', 'brand', 'manufacturer', 'device_type')} AS brand),
        {discount('price', 'original_price')} AS discount FROM priced)"""

_MADE = {
    "sku": "lpad(CAST(l_partkey AS VARCHAR), 8, '0')",
    "title": f"concat_ws(' ', {pick(views.MAKERS, 'l_partkey')}, {pick(views.THINGS, 'l_partkey + l_linenumber')})",
    "product_name": f"concat_ws(' ', {pick(views.MAKERS, 'l_partkey')}, {pick(views.THINGS, 'l_partkey')})",
    "brand": f"CASE WHEN l_partkey % 17 <> 0 THEN {pick(views.MAKERS, 'l_partkey')} END",
    "price": f"CASE WHEN l_linenumber <> 7 THEN {PC} / 100.0 END",
    "original_price": "(oc - CASE WHEN l_linenumber = 2 THEN 5000000 ELSE 0 END) / 100.0",
    "discount_percent": "CAST(CASE WHEN l_linenumber <> 6 THEN pct * 11 END AS DOUBLE)",
    "rating": "CAST(CASE WHEN l_linenumber <> 4 THEN CAST(l_quantity AS BIGINT) % 7 END AS DOUBLE)",
    "availability": f"CASE WHEN l_linenumber <> 5 THEN {pick(views.STATUSES, 'l_partkey')} ELSE {q(K.IN_STOCK)} END",
    "seller": "CASE WHEN l_linenumber = 1 THEN ' ' ELSE 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END",
    "product_url": f"{q(K.SITE_ROOT + '/dp/')} || l_partkey",
    "image_url": q(K.PLACEHOLDER),
    "device_type": f"CASE WHEN l_partkey % 19 <> 0 THEN {pick(views.THINGS, 'l_partkey')} END",
    **{
        n: f"CASE WHEN l_partkey % {i + 2} = 0 THEN {q(K.PLACEHOLDER)} ELSE {q(n + ' ')} || (l_partkey % {5 + i}) END"
        for i, n in enumerate(schemas.SPEC_COLUMNS)
    },
}
CLEAN = "batch AS (SELECT " + ", ".join(
    f"{_MADE[c]} AS {c}" for c in schemas.CLEAN_COLUMNS
) + f" FROM {_LINE})"

DETAIL = f"""detail AS (SELECT 'SKU' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS asin_key,
    CASE WHEN c_custkey % 3 = 0 THEN {capitalize('c_mktsegment')} ELSE '' END AS brand,
    CASE WHEN c_custkey % 4 = 0 THEN c_name END AS manufacturer,
    CASE WHEN c_custkey % 5 <> 0 THEN 'shade ' || (c_custkey % 9) END AS color,
    CASE WHEN c_custkey % 2 = 0 THEN 'Currently unavailable' END AS availability,
    CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS seller,
    'EGP ' || {thousands('balance')} AS price,
    CASE WHEN c_custkey % 6 = 0 THEN 'EGP ' || {thousands('balance * 2')} END AS original_price
    FROM (SELECT *, CAST(ROUND(abs(c_acctbal) * 100) AS BIGINT) AS balance FROM customer))"""
DETAIL_FIELDS = ("brand", "manufacturer", "color", "availability", "seller", "price", "original_price")

OLD_DIM = f"""old AS (SELECT o_orderkey AS product_id, 'SKU' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS sku,
    {_TITLE} AS title,
    CASE o_orderkey % 5 WHEN 0 THEN NULL
        WHEN 1 THEN concat_ws(' ', {pick(views.MAKERS, 'o_custkey')}, {pick(views.THINGS, 'o_orderkey')})
        WHEN 2 THEN ' '
        ELSE concat_ws(' ', {pick(views.MAKERS, 'o_custkey')}, {pick(views.ENDINGS, 'o_orderkey')}) END AS product_name,
    CASE o_orderkey % 4 WHEN 0 THEN 'unkown seller' WHEN 1 THEN {pick(views.MAKERS, 'o_orderkey')}
        WHEN 2 THEN 'Samsung' END AS brand,
    CASE WHEN o_orderkey % 6 < 3 THEN {pick(('Laptop', 'Tablet', 'Google pixel', 'N/A'), 'o_custkey')} END AS device_type,
    CASE o_orderkey % 3 WHEN 0 THEN ' Null ' WHEN 1 THEN 'red' END AS color,
    o_orderdate AS seen FROM orders)"""


def sweep(x: str) -> str:
    return (
        f"CASE WHEN coalesce(trim({x}) = '' OR lower(trim({x})) IN {some(K.SWEEP_MISSING)}, true)"
        f" THEN {q(K.PLACEHOLDER)} ELSE {x} END"
    )


def load_text(x: str) -> str:
    return f"coalesce(nullif({strip(x)}, ''), {q(K.PLACEHOLDER)})"


# --- numbers shown ------------------------------------------------------------------
def mean(x: str, unit: int = 1) -> str:
    """Mean in hundredths, half up; ``unit`` hundredths per one of ``x``."""
    return (
        f"CAST((2 * SUM({x}) * {unit} + COUNT({x})) // NULLIF(2 * COUNT({x}), 0) AS BIGINT) / 100.0"
    )


def settled(x: str, places: int) -> str:
    return f"CAST(ROUND(({x}) * {10 ** places}) AS BIGINT) / {float(10 ** places)}"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def second(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def count_if(x: str) -> str:
    return f"COUNT(*) FILTER (WHERE {x})"


def long_sum(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


_MEASURES = f"""COUNT(DISTINCT product_id) AS total_products, COUNT(*) AS total_snapshots,
    {mean('pc')} AS average_price, {mean('r', 100)} AS average_rating, {mean('d', 100)} AS average_discount,
    {mean('oc')} AS average_original_price, {second('MAX(seen)')} AS latest_snapshot,
    MAX(pc) / 100.0 AS max_price, MIN(pc) / 100.0 AS min_price,
    COUNT(DISTINCT CASE WHEN d > 0 THEN product_id END) AS discounted_products,
    COUNT(DISTINCT CASE WHEN d >= {HIGH_DISCOUNT} THEN product_id END) AS high_discount_products,
    (MAX(pc) - MIN(pc)) / 100.0 AS price_range,
    {settled('(MAX(pc) - MIN(pc)) / MIN(pc)', 4)} AS price_change_percent"""


def share(keys: str) -> str:
    return f"""WITH {BOTH}, n AS (SELECT {keys}, COUNT(DISTINCT product_id) AS products FROM j GROUP BY ALL)
        SELECT {keys}, products, CAST((2 * products * 10000 + t) // (2 * t) AS BIGINT) / 100.0 AS share_percent
        FROM n, (SELECT SUM(products) AS t FROM n)"""


def _reports() -> dict[str, str]:
    names = "product_name, title, brand, device_type"
    shown = "product_name, brand, device_type"
    offers = """pc / 100.0 AS price, oc / 100.0 AS original_price, CAST(d AS DOUBLE) AS discount_percent,
        availability, seller"""
    now = "TIMESTAMP '2001-11-05 07:30:00'"
    last_piece = "string_split(trim(product_name), ' ')[-1]"
    return {
        "kpi_summary": f"""WITH {BOTH} SELECT COUNT(DISTINCT product_id) AS total_products,
            COUNT(*) AS total_snapshots, {mean('pc')} AS avg_price, {mean('r', 100)} AS avg_rating,
            {mean('d', 100)} AS avg_discount_percent, {second('MAX(seen)')} AS latest_snapshot FROM j""",
        "by_device_brand": f"""WITH {BOTH} SELECT device_type, brand, COUNT(DISTINCT product_id) AS product_count,
            {mean('pc')} AS avg_price, {mean('r', 100)} AS avg_rating, {mean('d', 100)} AS avg_discount_percent
            FROM j GROUP BY device_type, brand""",
        "daily_price_trend": f"""WITH {BOTH} SELECT {day('seen')} AS snapshot_date, device_type, brand,
            {mean('pc')} AS avg_price, COUNT(*) AS snapshot_count FROM j GROUP BY ALL""",
        "top_rated": f"""WITH {BOTH} SELECT {names}, {mean('r', 100)} AS avg_rating, {mean('pc')} AS avg_price
            FROM j GROUP BY ALL ORDER BY avg_rating DESC NULLS FIRST, avg_price DESC NULLS FIRST, {names} LIMIT 20""",
        "price_changes": f"""WITH {BOTH}, g AS (SELECT product_id, {names}, MIN(pc) AS a, MAX(pc) AS b
            FROM j GROUP BY ALL) SELECT {names}, a / 100.0 AS min_price, b / 100.0 AS max_price,
            (b - a) / 100.0 AS price_change FROM g WHERE a IS NOT NULL
            ORDER BY price_change DESC, product_id LIMIT 20""",
        "best_discounts": f"""WITH {BOTH} SELECT {shown}, {offers}, {second('seen')} AS snapshot_timestamp FROM j
            WHERE d IS NOT NULL ORDER BY d DESC, pc, {shown}, oc, availability, seller, seen LIMIT 20""",
        "table_counts": f"""WITH {BOTH} SELECT 'dim_products' AS table_name, COUNT(*) AS row_count,
            CAST(NULL AS VARCHAR) AS latest_snapshot FROM dim UNION ALL
            SELECT 'fact_product_snapshots', COUNT(*), {second('MAX(seen)')} FROM fact""",
        "latest_snapshots": f"""WITH {FACT} SELECT {offers}, {second('seen')} AS snapshot_timestamp FROM fact
            ORDER BY seen DESC, pc NULLS FIRST, oc NULLS FIRST, d NULLS FIRST, availability, seller LIMIT 20""",
        "named_products": f"""WITH {OLD_DIM} SELECT sku, product_name, brand, device_type FROM old
            WHERE product_name IS NOT NULL ORDER BY sku LIMIT 20""",
        "freshness": f"""WITH {FACT}, m AS (SELECT MAX(seen) AS t FROM fact) SELECT {second('t')} AS latest_snapshot,
            date_sub('second', t, {now}) / 3600.0 AS age_hours, datediff('hour', t, {now}) AS hours_crossed,
            CAST(date_sub('second', t, {now}) <= 30 * 3600 AS BIGINT) AS fresh,
            CAST(datediff('hour', t, {now}) <= 30 AS BIGINT) AS fresh_by_hour FROM m""",
        "name_audit": f"""WITH {OLD_DIM} SELECT product_id, sku, product_name, title FROM old
            WHERE product_name IS NULL OR trim(product_name) = ''
            OR len(string_split(trim(product_name), ' ')) > 5
            OR lower({last_piece}) IN {some(K.NAME_TRAILING_WORDS)}
            OR regexp_full_match({last_piece}, '[0-9]+([.,][0-9]+)?')""",
        "stale_names": f"WITH {OLD_DIM} SELECT product_id, product_name FROM old WHERE {bad_name('product_name')}",
    }


def _texts() -> dict[str, str]:
    def docs(**columns: str) -> str:
        return "SELECT doc_id, " + ", ".join(f"{x} AS {n}" for n, x in columns.items()) + " FROM documents"

    def raw(**columns: str) -> str:
        return f"WITH {RAW} SELECT seq, " + ", ".join(f"{x} AS {n}" for n, x in columns.items()) + " FROM raw"

    def flag(x: str) -> str:
        return f"CAST({x} AS BIGINT)"

    p, o = price("price"), price("original_price")
    given = f"coalesce({device('title', 'category')}, {clean_text(capitalize('category'))})"
    return {
        "text_clean": docs(clean=clean_text("text")),
        "word_count": docs(words=words("text")),
        "trailing_noise": docs(noise=flag(trailing_noise("text"))),
        "product_name": f"""WITH {name_ctes('documents', 'doc_id', 'text', 'names')}
            SELECT doc_id, product_name FROM documents LEFT JOIN names ON k = doc_id""",
        "capitalize": docs(capitalized=capitalize("text")),
        "price_parse": docs(price=price("text")),
        "rating_parse": docs(rating=rating("text")),
        "availability_clean": docs(availability=availability("text")),
        "raw_prices": raw(price=p, original_price=o, rating=rating("rating")),
        "raw_names": f"""WITH {RAW}, {name_ctes('raw', 'seq', 'title', 'names')} SELECT seq, product_name,
            {words('title')} AS words, {flag(trailing_noise('title'))} AS noise, {capitalize('category')} AS category
            FROM raw LEFT JOIN names ON k = seq""",
        "raw_availability": raw(
            availability=availability("availability"), on_page=page_availability("availability"),
            shipping=flag(shipping("availability")),
        ),
        "missing_placeholder": raw(
            seller=or_placeholder("seller"), color=or_placeholder("color"),
            missing=flag(missing("seller")), loaded=load_text("seller"),
        ),
        "discount_percent": f"""WITH {RAW}, p AS (SELECT seq, {p} AS p, {o} AS o FROM raw)
            SELECT seq, {discount('p', 'o')} AS discount,
            CASE WHEN seq % 7 = 0 THEN 15.0 ELSE {discount('p', 'o')} END AS final_discount,
            'EGP' AS currency FROM p""".replace("THEN 15.0", "THEN CAST(15 AS DOUBLE)"),
        "device_type": raw(
            device_type=device("title", "category"),
            like_device=flag(any_class(low("brand"), K.DEVICE_TERMS)),
        ),
        "brand": raw(
            brand=brand("title", "brand", "manufacturer"), known=flag(any_class(low("brand"), K.BRAND_TERMS)),
        ),
        "document_classes": docs(
            device_type=first_class(low("text"), K.DEVICE_TERMS),
            brand=first_class(low("text"), K.BRAND_TERMS),
            has_hp=flag(any_class(low("text"), {"HP": ("hp",)})),
        ),
        "correct_record": f"""WITH {RAW}, g AS (SELECT *, {given} AS device FROM raw)
            SELECT seq, device AS device_type, {right_brand('title', 'brand', 'manufacturer', 'device')} AS brand
            FROM g""",
    }


def _first_by_asin(source: str, extra: str = "") -> str:
    return f"""firsts AS (SELECT * FROM {source} WHERE asin IS NOT NULL AND price IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY asin {extra} ORDER BY seq) = 1)"""


def _clean() -> dict[str, str]:
    text_columns = {
        "title": "title", "product_name": "names.product_name", "brand": "brand", "seller": "seller",
        "product_url": "product_url", "device_type": "device_type", "color": "color",
    }
    absent = [c for c in schemas.CLEAN_TEXTS if c not in text_columns and c != "availability"]
    batch = ", ".join(
        [f"{or_placeholder(clean_text(x))} AS {c}" for c, x in text_columns.items()]
        + [f"{q(K.PLACEHOLDER)} AS {c}" for c in absent]
    )
    return {
        "clean_transform": f"""WITH {RAW}, {SCORED}, {_first_by_asin('scored')},
            {name_ctes('firsts', 'seq', 'title', 'names')}
            SELECT seq, asin AS sku, price, {batch},
            {availability('availability')} AS availability,
            CASE WHEN original_price < price THEN price ELSE coalesce(original_price, price) END AS original_price,
            CASE WHEN original_price < price THEN CAST(0 AS DOUBLE)
                ELSE coalesce(discount, CAST(0 AS DOUBLE)) END AS discount_percent,
            coalesce(rating, CAST(0 AS DOUBLE)) AS rating FROM firsts LEFT JOIN names ON k = seq""",
        "dedup_first": f"""WITH {RAW} SELECT seq, product_url AS sku, title, price FROM raw
            QUALIFY row_number() OVER (PARTITION BY product_url ORDER BY seq) = 1""",
        "dedup_texts": f"""SELECT arg_min(doc_id, doc_id) AS seq, arg_min(source, doc_id) AS source
            FROM documents GROUP BY lower({strip('text')})""",
        "repair_prices": f"""WITH {CLEAN}, f AS (SELECT sku, {cents('price')} AS p, {cents('original_price')} AS o,
                CAST(coalesce(discount_percent, 0) AS BIGINT) * 100 AS d,
                CAST(coalesce(rating, 0) AS BIGINT) * 100 AS r FROM batch WHERE price IS NOT NULL)
            SELECT sku, COUNT(*) AS rows, {long_sum('p')} AS price_cents,
            {long_sum('CASE WHEN o < p THEN p ELSE o END')} AS original_price_cents,
            {long_sum('CASE WHEN o < p THEN 0 ELSE d END')} AS discount_percent_cents,
            {long_sum('r')} AS rating_cents FROM f GROUP BY sku""",
        "dq_report": _dq_report(),
        "dq_flaws": _dq_report(FLAWED),
        "report_sink": f"""WITH r AS ({_dq_report(FLAWED)}) SELECT 'failed' AS status, CAST(1 AS BIGINT) AS stopped,
            COUNT(*) FILTER (WHERE severity = 'failure' AND bad_rows > 0) AS failures,
            COUNT(*) FILTER (WHERE severity = 'warning' AND bad_rows > 0) AS warnings FROM r""",
        "quality_score": f"""WITH r AS ({_dq_report()}), g AS (SELECT rule, MAX(bad_rows) AS b FROM r GROUP BY rule)
            SELECT {settled('AVG(CASE WHEN b = 0 THEN 1.0 ELSE 0.0 END)', 6)} AS score FROM g""",
        "dq_gate": f"""WITH {RAW}, {SCORED}, {_first_by_asin('scored')},
            b AS (SELECT CAST((COUNT(*) < 1) AS BIGINT)
                + CAST((COUNT(*) FILTER (WHERE rating > 5 OR discount > 100 OR price < 0) > 0) AS BIGINT) AS bad
                FROM firsts)
            SELECT CASE WHEN bad > 0 THEN 'failed' ELSE 'passed' END AS status, bad AS failures,
            CAST(0 AS BIGINT) AS warnings FROM b""",
    }


# The clean batch with blank names, long names and negative prices.
FLAWED = CLEAN.replace("batch AS", "fine AS", 1) + """, batch AS (SELECT * REPLACE (
    CASE WHEN CAST(sku AS BIGINT) % 23 = 0 THEN '  ' WHEN CAST(sku AS BIGINT) % 29 = 0 THEN 'one two three four five six'
        ELSE product_name END AS product_name,
    CASE WHEN CAST(sku AS BIGINT) % 31 = 0 THEN -price ELSE price END AS price) FROM fine)"""


def _dq_report(batch: str = CLEAN) -> str:
    texts = ["sku", *schemas.CLEAN_TEXTS]
    markers = [m for m in K.CLEAN_MISSING if m != K.PLACEHOLDER.lower()]
    rules = [("required_not_null", "failure", c, f"{c} IS NULL")
             for c in ("sku", "title", "product_name", "price", "device_type")]
    rules += [("null_cell", "failure", c, f"{c} IS NULL") for c in schemas.CLEAN_COLUMNS]
    rules += [("missing_marker", "failure", c,
               f"{c} IS NULL OR lower({strip(c)}) IN {some(markers)}") for c in texts]
    rules += [("blank_text", "failure", c, f"{strip(c)} = ''") for c in texts]
    rules += [
        ("shipping_in_availability", "failure", "availability", shipping("availability")),
        ("blank_name", "failure", "product_name", f"{strip('product_name')} = ''"),
        ("noise_at_name_end", "failure", "product_name", trailing_noise("product_name")),
        ("long_name", "failure", "product_name", f"{words('product_name')} > 5"),
        ("negative_price", "failure", "price", "price < 0"),
        ("rating_range", "failure", "rating", "rating < 0 OR rating > 5"),
        ("original_below_price", "warning", "original_price", "original_price < price"),
        ("discount_range", "failure", "discount_percent", "discount_percent < 0 OR discount_percent > 100"),
    ]
    counts = ", ".join(f"{count_if(x)} AS c{i}" for i, (_, _, _, x) in enumerate(rules))
    rows = " UNION ALL ".join(
        f"SELECT {q(r)} AS rule, {q(s)} AS severity, {q(c)} AS column_name, c{i} AS bad_rows FROM n"
        for i, (r, s, c, _) in enumerate(rules)
    )
    return f"""WITH {batch}, n AS (SELECT {counts}, COUNT(*) AS total, COUNT(DISTINCT sku) AS skus FROM batch) {rows}
        UNION ALL SELECT 'min_rows', 'failure', '*', greatest(1 - total, 0) FROM n
        UNION ALL SELECT 'duplicate_sku', 'warning', 'sku', total - skus FROM n"""


def full_url(x: str) -> str:
    return f"{q(K.SITE_ROOT)} || {x}"


_NORMAL = (
    f"CASE WHEN product_url = '' THEN '' WHEN product_url LIKE '%url=%'"
    f" THEN {full_url("replace(regexp_extract(product_url, 'url=(.*)', 1), '%2F', '/')")}"
    f" ELSE {full_url('product_url')} END"
)
_KEY = "upper(coalesce(trim(asin), ''))"


def _identity(row: str) -> str:
    return (
        f"CASE WHEN {_KEY} <> '' THEN 'asin:' || {_KEY} WHEN {_NORMAL} <> '' THEN 'url:' || {_NORMAL}"
        f" ELSE 'row:' || {row} END"
    )


def _merge() -> dict[str, str]:
    side = "CASE WHEN batch_date < DATE '1998-01-01' THEN 0 ELSE 1 END"
    merged = ", ".join(
        f"arg_max({c}, side * 1000000000000 + seq) FILTER (WHERE {c} <> '') AS {c}" for c in MERGED
    )
    filled = ", ".join(
        f"CASE WHEN r.{c} <> '' THEN r.{c} ELSE coalesce(nullif(d.{c}, ''), r.{c}) END AS {c}"
        for c in DETAIL_FIELDS
    )
    kept = ", ".join(f"nullif({c}, '') AS {c}" for c in DETAIL_FIELDS)
    return {
        "merge_batches": f"""WITH {RAW}, s AS (SELECT *, {side} AS side,
                {_identity(f"({side}) || '/' || seq")} AS identity FROM raw)
            SELECT identity, CAST(MIN(side) AS BIGINT) AS batch,
            arg_min(seq, side * 1000000000000 + seq) AS seq, {merged} FROM s GROUP BY identity""",
        "enrich_details": f"""WITH {RAW}, {DETAIL} SELECT seq, asin, {filled}
            FROM (SELECT *, {_KEY} AS key FROM raw) r LEFT JOIN detail d ON d.asin_key = r.key AND r.key <> ''""",
        "detail_cache": f"""WITH {RAW}, {DETAIL},
            n AS (SELECT {_KEY} AS asin_key, {kept} FROM raw WHERE {_KEY} <> ''
                QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY seq DESC) = 1)
            SELECT * FROM n UNION ALL BY NAME
            SELECT * FROM detail WHERE asin_key NOT IN (SELECT asin_key FROM n)""",
        "detail_worklist": f"""WITH {RAW} SELECT {_KEY} AS asin_key, MIN(seq) AS seq FROM raw
            WHERE {_KEY} <> '' AND {_KEY} NOT IN (SELECT 'SKU' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')
                FROM customer WHERE c_custkey % 3 <> 0) GROUP BY 1""",
        "detail_worklist_capped": f"""WITH {RAW} SELECT {_KEY} AS asin_key, MIN(seq) AS seq FROM raw
            WHERE {_KEY} <> '' GROUP BY 1 ORDER BY seq LIMIT 100""",
    }


def _warehouse() -> dict[str, str]:
    null = "CAST(NULL AS VARCHAR)"
    other = [c for c in schemas.DIM_ATTRIBUTES
             if c not in ("title", "product_name", "brand", "device_type", "color")]
    dev = f"coalesce({device('title', 'NULL')}, {clean_text('device_type')})"
    part_code = "'SKU' || lpad(CAST(p_partkey AS VARCHAR), 8, '0')"
    status = sweep(load_text(clean_text("availability")))
    periods = " ".join(
        f"WHEN batch_date < DATE {q(end)} THEN {i}" for i, end in enumerate(PERIODS)
    ) + " ELSE 2"
    sep = ", "
    merged = ", ".join(f"arg_max({c}, place) FILTER (WHERE {c} <> '') AS {c}" for c in MERGED)
    return {
        "dim_upsert": f"""WITH {DIM}, s AS (SELECT CAST(l_partkey * 2 AS VARCHAR) AS sku,
                'Offer Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS title,
                'Offer ' || l_returnflag AS product_name,
                'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS brand, l_linestatus AS device_type
                FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC,
                    l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_returnflag DESC, l_linestatus DESC) = 1),
            n AS (SELECT s.*, (SELECT MAX(product_id) FROM dim)
                + row_number() OVER (ORDER BY sku) AS product_id
                FROM s WHERE sku NOT IN (SELECT sku FROM dim))
            SELECT dim.product_id, dim.sku, {sep.join(
                f"CASE WHEN s.sku IS NULL THEN dim.{c} ELSE s.{c} END AS {c}"
                for c in ("title", "product_name", "brand", "device_type"))},
                CASE WHEN s.sku IS NOT NULL THEN {q(K.PLACEHOLDER)} END AS color,
                {null} AS created_at, CASE WHEN s.sku IS NOT NULL THEN {q(LOAD)} END AS updated_at
            FROM dim LEFT JOIN s ON s.sku = dim.sku UNION ALL
            SELECT product_id, sku, title, product_name, brand, device_type, {q(K.PLACEHOLDER)}, {q(LOAD)}, {q(LOAD)}
            FROM n""",
        "fact_append": f"""WITH {RAW}, {SCORED} SELECT
            1000 + row_number() OVER (ORDER BY seq) AS snapshot_id,
            p_partkey AS product_id, price, 'EGP' AS currency, original_price, discount AS discount_percent, rating,
            CASE WHEN {shipping(status)} THEN {q(K.PLACEHOLDER)} ELSE {status} END AS availability,
            {sweep(load_text(clean_text('seller')))} AS seller, {q(LOAD)} AS snapshot_timestamp,
            {q(LOAD[:10])} AS snapshot_date, CAST(1 AS BIGINT) AS batch_id
            FROM scored JOIN part ON {part_code} = asin""",
        "dim_backfill": f"""WITH {OLD_DIM}, {name_ctes('old', 'product_id', 'title', 'names')},
            d AS (SELECT *, {dev} AS dev FROM old),
            b AS (SELECT *, coalesce({right_brand('title', 'brand', 'NULL', 'dev')}, {q(K.PLACEHOLDER)}) AS right_b,
                coalesce(dev, {q(K.PLACEHOLDER)}) AS right_d FROM d),
            c AS (SELECT *, {bad_name('product_name')} OR brand IS DISTINCT FROM right_b
                OR device_type IS DISTINCT FROM right_d AS changed FROM b)
            SELECT product_id, CASE WHEN changed THEN
                coalesce(names.product_name, nullif(c.product_name, ''), {q(K.PLACEHOLDER)})
                ELSE c.product_name END AS product_name,
            CASE WHEN changed THEN right_b ELSE brand END AS brand,
            CASE WHEN changed THEN right_d ELSE device_type END AS device_type,
            CASE WHEN changed THEN {q(LOAD)} ELSE {second('seen')} END AS updated_at,
            CAST(changed AS BIGINT) AS needs_refresh FROM c LEFT JOIN names ON k = product_id""",
        "missing_sweep": f"WITH {OLD_DIM} SELECT product_id, " + ", ".join(
            f"{sweep(c)} AS {c}" for c in ("title", "product_name", "brand", "device_type", "color")
        ) + " FROM old",
        "fact_sweep": f"""WITH {RAW} SELECT seq, CASE WHEN {shipping(sweep('availability'))} THEN {q(K.PLACEHOLDER)}
            ELSE {sweep('availability')} END AS availability, {sweep('seller')} AS seller, 'EGP' AS currency FROM raw""",
        "schema_evolve": f"""WITH {OLD_DIM} SELECT product_id, sku, title, product_name, brand,
            coalesce(device_type, brand) AS device_type, color, {", ".join(f"{null} AS {c}" for c in other)},
            {second('seen')} AS created_at, {second('seen')} AS updated_at FROM old""",
        "warehouse_history": f"""WITH {FACT}, {RAW}, {SCORED},
            dated AS (SELECT *, CASE {periods} END AS period FROM scored),
            {_first_by_asin('dated', ', period')},
            both_parts AS (SELECT pc AS c, CAST(NULL AS VARCHAR) AS asin FROM fact UNION ALL
                SELECT {cents('price')}, asin FROM firsts WHERE period < 2)
            SELECT COUNT(*) AS snapshots, COUNT(asin) AS ids, {long_sum('c')} AS price_cents,
            COUNT(DISTINCT asin) + (SELECT COUNT(*) FROM part) AS products FROM both_parts""",
        "warehouse_create": f"""WITH {RAW}, {SCORED}, {_first_by_asin('scored')}
            SELECT 'batch' AS writer, CAST(1 AS BIGINT) AS batch_id, COUNT(*) AS snapshots, CAST(0 AS BIGINT) AS rows_before,
            CAST(0 AS BIGINT) AS repeated_skus FROM firsts""",
        "batch_job": f"""SELECT warehouse, 'P' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS sku,
            'Galaxy phone ' || c_mktsegment AS title,
            CASE WHEN row_number() OVER (PARTITION BY warehouse ORDER BY c_custkey) <= 200 THEN 'shade ' || (c_custkey % 9)
                ELSE {q(K.PLACEHOLDER)} END AS color, CAST(4 AS BIGINT) AS snapshots,
            CAST(ROUND(abs(c_acctbal) * 100) AS BIGINT) / 100.0 AS price
            FROM customer, (VALUES ('first'), ('second')) AS w(warehouse)""",
        "read_pages": "SELECT page_id, url, length(html) AS n_chars FROM pages",
        "raw_sink": f"WITH {RAW} SELECT seq, asin, product_url, title, price, color FROM raw",
        "raw_scan": f"WITH {RAW} SELECT asin, product_url, title, price, rating, seller, color FROM raw",
        "clean_csv_roundtrip": f"""SELECT sku, title, product_name, price, original_price, discount_percent, rating, color
            FROM ({_clean()['clean_transform']})""",
        "dq_missing_columns": """SELECT * FROM (VALUES ('required_column', 'failure', 'seller', CAST(1 AS BIGINT)),
            ('required_column', 'failure', 'price', 1)) AS v(rule, severity, column_name, bad_rows)
            UNION ALL SELECT 'min_rows', 'failure', '*', 1000000000000 - COUNT(*) FROM lineitem""",
        "incremental_load": f"""WITH {RAW.replace('raw AS', 'landed AS', 1)},
            dated AS (SELECT *, CASE {periods} END AS period FROM landed),
            keyed AS (SELECT *, period * 1000000000000 + seq AS place, {_identity("period || '/' || seq")} AS identity FROM dated),
            raw AS (SELECT 0 AS run, place AS seq, {', '.join(MERGED)} FROM keyed WHERE period = 0 UNION ALL {' UNION ALL '.join(
                f"SELECT {n}, MIN(place), {merged} FROM keyed WHERE period <= {n} GROUP BY identity" for n in (1, 2))}),
            {SCORED}, {_first_by_asin('scored', ', run')}
            SELECT asin AS sku, COUNT(*) AS snapshots, MIN(price) AS min_price, MAX(price) AS max_price,
            {long_sum(cents('coalesce(discount, 0)'))} / 100.0 AS discounts FROM firsts GROUP BY asin""",
    }


def _dashboard() -> dict[str, str]:
    def measures(keys: str) -> str:
        head = f"{keys}, " if keys else ""
        return f"WITH {BOTH} SELECT {head}{_MEASURES} FROM j" + (" GROUP BY ALL" if keys else "")

    def over_time(keys: str = "") -> str:
        return (
            f"WITH {BOTH} SELECT {second('seen')} AS snapshot_timestamp, {keys}{mean('pc')} AS average_price"
            " FROM j GROUP BY ALL"
        )

    devices = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    pivot = ", ".join(
        f"COUNT(DISTINCT CASE WHEN device_type = {q(d)} THEN product_id END) AS {q(d).replace(chr(39), chr(34))}"
        for d in devices
    ) + ", COUNT(DISTINCT CASE WHEN device_type IS NULL OR device_type NOT IN (" + ", ".join(map(q, devices)) + ") THEN product_id END) AS other"
    return {
        "measures": measures(""),
        "measures_by_brand": measures("brand"),
        "measures_by_seller_device": measures("seller, device_type"),
        "discounted_products": f"""WITH {BOTH} SELECT device_type,
            COUNT(DISTINCT CASE WHEN d > 0 THEN product_id END) AS discounted_products,
            COUNT(DISTINCT CASE WHEN d >= {HIGH_DISCOUNT} THEN product_id END) AS high_discount_products
            FROM j GROUP BY device_type""",
        "products_by_brand": share("brand"),
        "share_by_device": share("device_type"),
        "matrix": share("device_type, brand"),
        "matrix_pivot": f"WITH {BOTH} SELECT brand, {pivot} FROM j GROUP BY brand",
        "price_over_time": over_time(),
        "price_over_time_by_device": over_time("device_type, "),
        "price_over_time_by_brand": over_time("brand, "),
        "price_change_by_product": f"""WITH {BOTH} SELECT product_name, (MAX(pc) - MIN(pc)) / 100.0 AS price_range,
            {settled('(MAX(pc) - MIN(pc)) / MIN(pc)', 4)} AS price_change_percent FROM j GROUP BY product_name""",
        "price_vs_discount": f"""WITH {BOTH} SELECT product_name, brand, {mean('pc')} AS average_price,
            {mean('d', 100)} AS average_discount FROM j GROUP BY product_name, brand""",
        "price_by_brand": f"WITH {BOTH} SELECT brand, {mean('pc')} AS average_price FROM j GROUP BY brand",
        "price_vs_discount_by_brand": f"""WITH {BOTH} SELECT brand, {mean('pc')} AS average_price,
            {mean('d', 100)} AS average_discount FROM j GROUP BY brand""",
        "product_details": f"""WITH {BOTH} SELECT product_name, device_type, brand, seller, availability,
            COUNT(*) AS snapshots, {mean('pc')} AS average_price, {mean('r', 100)} AS average_rating
            FROM j GROUP BY ALL""",
        "snapshot_growth": f"""WITH {FACT}, g AS (SELECT {day('seen')} AS snapshot_date, COUNT(*) AS snapshots
            FROM fact GROUP BY 1) SELECT *, CAST(SUM(snapshots) OVER (ORDER BY snapshot_date) AS BIGINT)
            AS total_snapshots FROM g""",
        "freshness_status": f"""WITH {FACT}, m AS (SELECT MAX(seen) AS t FROM fact) SELECT {second('t')} AS latest_snapshot,
            datediff('day', t, TIMESTAMP '2001-11-05 07:30:00') AS days_since_last_snapshot,
            CASE WHEN datediff('day', t, TIMESTAMP '2001-11-05 07:30:00') <= 1 THEN 'Fresh' ELSE 'Stale' END
            AS freshness_status FROM m""",
        "quality_checks": f"""WITH {DIM}, {FACT}, c AS (
            SELECT 'duplicate_sku' AS check_name, COUNT(*) - COUNT(DISTINCT sku) AS bad_rows FROM dim
            UNION ALL SELECT 'missing_brand', {count_if("coalesce(trim(brand), '') = ''")} FROM dim
            UNION ALL SELECT 'missing_price', {count_if('pc IS NULL')} FROM fact
            UNION ALL SELECT 'invalid_ratings', {count_if('r < 0 OR r > 5')} FROM fact
            UNION ALL SELECT 'warehouse_freshness',
                CAST(datediff('day', MAX(seen), TIMESTAMP '2001-11-05 07:30:00') > 1 AS BIGINT) FROM fact)
            SELECT *, CAST(bad_rows = 0 AS BIGINT) AS passed FROM c""",
    }


def _profile() -> dict[str, str]:
    gone = f"IN {some(K.PROFILE_MISSING)}"

    def off(c: str) -> str:
        return f"({c} IS NULL OR lower({strip(f'CAST({c} AS VARCHAR)')}) {gone})"

    columns = schemas.CLEAN_COLUMNS
    numbers = schemas.CLEAN_NUMBERS
    probs = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)

    def percent(part: str, total: str) -> str:
        return f"CAST((2 * ({part}) * 10000 + ({total})) // (2 * ({total})) AS BIGINT) / 100.0"

    per_column = " UNION ALL ".join(
        f"""SELECT {q(c)} AS column_name, {q('double' if c in numbers else 'string')} AS dtype,
        {count_if(f'{c} IS NULL')} AS null_count,
        {percent(count_if(f'{c} IS NULL'), 'COUNT(*)')} AS null_percent,
        COUNT(DISTINCT {c}) AS unique_count, {count_if(off(c))} AS not_available_count FROM batch"""
        for c in columns
    )
    described = " UNION ALL ".join(
        f"""SELECT {q(c)} AS column_name, COUNT({c}) AS count, {settled(f'AVG({c})', 4)} AS mean,
        {settled(f'stddev_samp({c})', 4)} AS std, {settled(f'MIN({c})', 4)} AS min, """
        + ", ".join(f"{settled(f'quantile_cont({c}, {p})', 4)} AS p{round(p * 100):02d}" for p in probs)
        + f", {settled(f'MAX({c})', 4)} AS max FROM batch"
        for c in numbers
    )
    metrics = {
        "rows": "COUNT(*)",
        "columns": f"COUNT(*) * 0 + {len(columns)}",
        "duplicate_sku_rows": "COUNT(*) - COUNT(DISTINCT sku)",
        "total_null_cells": " + ".join(count_if(f"{c} IS NULL") for c in columns),
        "total_blank_cells": " + ".join(
            count_if(f"{strip(f'CAST({c} AS VARCHAR)')} = ''") for c in columns),
        "price_null_rows": count_if("price IS NULL"),
        "price_lte_zero_rows": count_if("price <= 0"),
        "rating_outside_0_5_rows": count_if("rating < 0 OR rating > 5"),
        "discount_outside_0_100_rows": count_if("discount_percent < 0 OR discount_percent > 100"),
        "original_price_lower_than_price_rows": count_if("original_price < price"),
    }
    business = {
        "unique_sku": "COUNT(DISTINCT sku)",
        "device_types": "COUNT(DISTINCT device_type)",
        "brands": "COUNT(DISTINCT brand)",
        "sellers": "COUNT(DISTINCT seller)",
        "products_with_seller": count_if(f"NOT {off('seller')}"),
        "products_with_availability": count_if(f"NOT {off('availability')}"),
        "products_with_discount_gt_0": count_if("discount_percent > 0"),
        "median_price": "quantile_cont(price, 0.5)",
        "avg_price": "AVG(price)",
        "max_price": "MAX(price)",
    }

    def counts(column: str, n: int | None = None) -> str:
        return (
            f"WITH {CLEAN} SELECT coalesce({column}, 'Not available') AS {column}, COUNT(*) AS products"
            f" FROM batch GROUP BY 1 ORDER BY products DESC, 1" + (f" LIMIT {n}" if n else "")
        )

    def histogram(values: str, bins: int) -> str:
        return f"""WITH {CLEAN}, v AS ({values}), e AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM v),
            c AS (SELECT CAST(least(floor((x - lo) * {bins} / (hi - lo)) + 1, {bins}) AS BIGINT) AS bin,
                COUNT(*) AS n FROM v, e GROUP BY 1),
            b AS (SELECT CAST(range AS BIGINT) AS bin FROM range(1, {bins + 1}))
            SELECT bin, {settled(f'lo + (hi - lo) / {float(bins)} * (bin - 1)', 3)} AS from_value,
            {settled(f'lo + (hi - lo) / {float(bins)} * bin', 3)} AS to_value, coalesce(n, 0) AS rows
            FROM b CROSS JOIN e LEFT JOIN c USING (bin)"""

    shown = ("sku", "title", "brand", "device_type", "price", "original_price", "discount_percent",
             "rating", "seller", "availability", "product_url")

    def top(*keys: str) -> str:
        rest = ", ".join(f"{c} NULLS FIRST" for c in shown if c not in keys)
        first = ", ".join(f"{c} DESC NULLS LAST" for c in keys)
        return f"WITH {CLEAN} SELECT {', '.join(shown)} FROM batch ORDER BY {first}, {rest} LIMIT 10"

    complete = ("seller", "availability", "original_price", "discount_percent", "brand",
                "product_name", "product_url", "image_url")
    return {
        "column_audit": f"WITH {CLEAN} " + " UNION ALL ".join(
            f"""SELECT {q(c)} AS column_name, CAST({int(c in schemas.REQUIRED_COLUMNS)} AS BIGINT) AS is_required,
            CAST(1 AS BIGINT) AS is_present, COUNT({c}) AS filled_rows FROM batch""" for c in columns
        ),
        "quality_summary": f"WITH {CLEAN} " + " UNION ALL ".join(
            f"SELECT {q(m)} AS metric, CAST({x} AS BIGINT) AS value FROM batch" for m, x in metrics.items()
        ),
        "column_profile": f"WITH {CLEAN} {per_column}",
        "overview": f"WITH {CLEAN} " + " UNION ALL ".join(
            f"SELECT {q(m)} AS metric, {settled(x, 4)} AS value FROM batch" for m, x in business.items()
        ),
        "device_counts": counts("device_type"),
        "profile_sink": f"""SELECT device_type AS name, products, 'device' AS profile FROM ({counts("device_type")}) UNION ALL
            SELECT brand, products, 'brand' FROM ({counts("brand", 20)})""",
        "top_brands": counts("brand", 20),
        "top_sellers": counts("seller", 20),
        "availability_counts": counts("availability", 30),
        "describe": f"WITH {CLEAN} {described}",
        "price_by_device": f"""WITH {CLEAN} SELECT device_type, COUNT(sku) AS products,
            {settled('quantile_cont(price, 0.5)', 4)} AS median_price, {settled('AVG(price)', 4)} AS avg_price,
            {settled('MIN(price)', 4)} AS min_price, {settled('MAX(price)', 4)} AS max_price,
            {settled('AVG(discount_percent)', 4)} AS avg_discount FROM batch GROUP BY device_type""",
        "histogram": histogram(
            "SELECT least(price, (SELECT quantile_cont(price, 0.99) FROM batch)) AS x FROM batch"
            " WHERE price IS NOT NULL", 40),
        "discount_histogram": histogram(
            "SELECT discount_percent AS x FROM batch WHERE discount_percent > 0", 30),
        "top_priced": top("price"),
        "top_discounted": top("discount_percent"),
        "top_products": top("rating", "price"),
        "completeness": f"WITH {CLEAN} " + " UNION ALL ".join(
            f"""SELECT {q(c)} AS column_name, COUNT(*) - {count_if(off(c))} AS available_rows,
            {count_if(off(c))} AS unavailable_or_blank_rows,
            {percent(f'COUNT(*) - {count_if(off(c))}', 'COUNT(*)')} AS available_percent FROM batch"""
            for c in complete
        ),
    }


def _pages() -> dict[str, str]:
    blocked = " OR ".join(f"contains(lower(h), {q(m)})" for m in K.BLOCKED_MARKERS)
    key = "CAST(o_orderkey AS VARCHAR)"
    amount = "CAST(ROUND(o_totalprice * 100) AS BIGINT)"
    part_amount = "CAST(ROUND(p_retailprice * 100) AS BIGINT)"

    def body(pattern: str) -> str:
        found = f"regexp_extract(html, {q('(?s)' + pattern)}, 1)"
        for code, char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
            found = f"replace({found}, {q(code)}, {q(char)})"
        return squeeze(found)

    def times(part: str) -> str:
        return f"CAST((length(html) - length(replace(html, {q(part)}, ''))) / {len(part)} AS BIGINT)"

    even = "p_partkey % 2 = 0"
    empty = ("screen_size", "storage_capacity", "processor", "gpu", "operating_system",
             "display_resolution", "connectivity", "product_dimensions", "manufacturer")
    return {
        "blocked_pages": f"""WITH p AS (SELECT page_id, url, CASE WHEN page_id % 7 = 0
            THEN html || '<b>OPFcaptcha</b>' ELSE html END AS h FROM pages)
            SELECT page_id, url FROM p WHERE NOT ({blocked})""",
        "canonical_url": f"""WITH {RAW} SELECT seq, CASE WHEN coalesce(trim(asin), '') = '' THEN ''
            ELSE {q(K.SITE_ROOT + K.PRODUCT_PATH)} || trim(asin) END AS canonical,
            {_NORMAL} AS normalized, {_identity('seq')} AS identity FROM raw""",
        "seller_clean": "SELECT s_suppkey, s_name AS seller FROM supplier WHERE s_suppkey % 7 <> 5"
            f" UNION ALL SELECT s_suppkey, {q(K.HOUSE_SELLER)} FROM supplier WHERE s_suppkey % 7 = 5",
        "listing_extract": f"""SELECT o_orderkey AS page_id, CAST(0 AS BIGINT) AS position, 'A' || {key} AS asin,
            'Phone & case ' || {key} AS title, 'EGP ' || {thousands(amount)} AS price,
            'EGP ' || {thousands(amount + ' * 2')} AS original_price, '4.5 out of 5 stars' AS rating,
            '/i/' || {key} || '.jpg' AS image_url, {q(K.SITE_ROOT + '/dp/A')} || {key} AS product_url,
            lower(o_orderpriority) AS category, lower(o_orderpriority) AS source_search_term,
            'Best Seller' AS listing_badges FROM orders UNION ALL
            SELECT o_orderkey, CAST(2 AS BIGINT), 'B' || {key}, 'Plain ' || o_orderpriority, '0', '',
            '0 out of 5 stars', '', '', lower(o_orderpriority), lower(o_orderpriority), '' FROM orders""",
        "listing_variants": f"""SELECT o_orderkey AS page_id, 'V' || {key} AS asin, 'Two-part ' || {key} AS title,
            {amount} // 100 || '.' || lpad(CAST({amount} % 100 AS VARCHAR), 2, '0') AS price, 'EGP 9' AS original_price,
            '0 out of 5 stars' AS rating, {q(K.SITE_ROOT + '/dp/V')} || {key} AS product_url, 'Ad ' || {key} AS badges FROM orders""",
        "detail_variants": f"""SELECT p_partkey AS page_id, 'C' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS page_code,
            CAST({part_amount} / 100.0 AS VARCHAR) AS price,
            CASE p_partkey % 4 WHEN 3 THEN CAST({part_amount} * 2 / 100.0 AS VARCHAR) END AS original_price,
            CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'Shown ' || p_partkey WHEN 2 THEN 'Box ' || p_partkey
                ELSE 'Zed ' || p_partkey END AS seller FROM part""",
        "detail_extract": f"""SELECT p_partkey AS page_id, 'B0' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS page_code,
            p_brand AS brand, 'M ' || p_partkey AS model_number, p_type AS color, p_size || ' GB' AS ram_memory,
            {", ".join(f"'' AS {c}" for c in empty)}, p_size || ' g' AS item_weight,
            CASE WHEN {even} THEN 'In Stock' ELSE 'Only ' || p_partkey || ' left in stock - order soon.' END AS availability,
            'Shop ' || p_partkey AS seller, CAST({part_amount} / 100.0 AS VARCHAR) AS price,
            CAST({part_amount} * CASE WHEN {even} THEN 2 ELSE 4 END / 100.0 AS VARCHAR) AS original_price,
            CASE WHEN p_partkey % 3 = 0 THEN '12.5' WHEN {even} THEN '50.0' ELSE '75.0' END AS discount_percent,
            'About ' || p_name AS product_description, 'One|' || p_name AS bullet_points,
            'Colour=' || p_type || '|Item Weight=' || p_size || ' g|Item model number=M ' || p_partkey
                || '|RAM=' || p_size || ' GB' AS product_specs FROM part""",
        "page_extract": f"""SELECT page_id, {body('<title>(.*?)</title>')} AS title, {body('<h1>(.*?)</h1>')} AS heading,
            {times('<li><a href=')} AS n_links, regexp_extract(html, '<li><a href="([^"]*)"', 1) AS first_link,
            {times('<p>')} AS n_paragraphs, {body('<div class="ad">(.*?)</div>')} AS ad,
            {body('<footer>(.*?)</footer>')} AS foot FROM pages""",
    }


def oracle_sql() -> dict[str, str]:
    return {
        **_reports(), **_texts(), **_clean(), **_merge(), **_warehouse(), **_dashboard(),
        **_profile(), **_pages(),
    }

import pytest
from pyspark.sql import functions as F

from shelfwatch.functions import classify, fixed as K, numbers, text, urls

PH = K.PLACEHOLDER


def check(apply, function, cases, kinds=None):
    given = [a if isinstance(a, tuple) else (a,) for a, _ in cases]
    got = apply(function, *given, kinds=kinds)
    assert dict(zip(map(str, given), got)) == dict(zip(map(str, given), [b for _, b in cases]))


def test_clean_text(apply):
    check(apply, text.clean_text, [
        (None, None), ("", None), ("  \t\n ", None), (" a  b ", "a b"), ("a  b", "a b"),
        ("a\x1cb", "a b"), ("　x", "x"), ("a\t b", "a b"), ("é​é", "é​é"), ("a b c", "a b c"),
    ])


def test_missing(apply):
    check(apply, text.is_missing, [
        (None, True), (" ", True), ("Not  Available", True), ("UNKNOWN seller", True), ("nan", True),
        ("N/A", False), (PH, True), ("red", False),
    ])
    check(apply, text.or_placeholder, [("None", PH), ("N/A", "N/A"), (None, PH)])
    check(apply, text.load_text, [(None, PH), ("  ", PH), (" a  b ", "a  b")])


def test_availability(apply):
    check(apply, text.clean_availability, [
        ("in stock.", "In Stock"), ("AVAILABLE!", "In Stock"), ("Out of stock", "Currently unavailable"),
        ("currently unavailable.", "Currently unavailable"), ("Ships in 2 days", PH), ("membership only", "membership only"),
        (None, PH), ("null", PH), ("FREE Delivery", PH), ("Only 3  left", "Only 3 left"),
        ("in stocks", "in stocks"), ("delivered", PH), ("été livraison", "été livraison"), ("éship", "éship"),
    ])
    check(apply, text.page_availability, [(None, ""), ("", ""), ("ship it", ""), ("Unavailable", "Currently unavailable")])


def test_product_name(apply):
    check(apply, text.product_name, [
        ("Acme Phone X for kids", "Acme Phone X"), ("for to Acme One", "Acme One"), ("Acme Tab-10 black", "Acme Tab"),
        ("A1 B2 C3 D4 E5 F6", "A1 B2 C3 D4 E5"), ("Acme Pro with 12", "Acme Pro"), ("12", None), (None, None), ("", None),
        ("12, Acme X", "Acme X"), ("with: Acme", "Acme"), ("(Acme) [Pro] !!! X", "Acme Pro X"), ("-10 Acme", "Acme"),
        ("هاتف سامسونج جالاكسي", "هاتف سامسونج جالاكسي"), ("Acme up to 20W", "Acme"), ("Acme 5.5 3,2", "Acme"),
        ("a_b c", "c"), ("Acme, Pro", "Acme"), ("Zoë Café x²", "Zoë Café x²"),
    ])


def test_name_parts(apply):
    check(apply, text.has_trailing_noise, [
        ("Acme and", True), ("Acme 12", True), ("Acme 1.5", True), ("Acme X", False), (None, False), ("  ", False),
        ("x\nThe ", True), ("Acme 1.", False),
    ])
    check(apply, text.word_count, [(None, 0), (" ", 0), ("a\t b c", 3), ("one", 1)])
    check(apply, text.capitalize, [("android TABLET", "Android tablet"), ("", ""), (None, None)])
    check(apply, text.needs_new_name, [(None, True), ("", True), ("a b c d e f", True), ("Acme X", False), ("Acme for", True)])


def test_price(apply):
    check(apply, numbers.clean_price, [
        ("EGP 15,000.50", 15000.5), ("1.234.567", 1234567.0), ("EGP. 15", None), ("Was, 100", None), ("-5", 5.0),
        ("5.", 5.0), ("", None), (None, None), ("free", None), ("٣٢١ ج", 321.0), ("1,299..00", 129900.0), (".5", 0.5),
        ("a\n7", 7.0),
    ])


def test_rating(apply):
    check(apply, numbers.rating_score, [
        ("4.5 out of 5 stars", 4.5), ("4,5", 4.0), ("3", 3.0), ("none", None), ("...", None), (None, None),
    ])


def test_discount(apply):
    check(apply, numbers.discount_percent, [
        ((75.0, 100.0), 25.0), ((0.0, 100.0), 100.0), ((120.0, 100.0), None), ((10.0, 0.0), None),
        ((None, 10.0), None), ((1.0, None), None), ((2.0, 3.0), 33.33), ((198.99, 200.0), 0.51),
        ((1e20, 2e20), 50.0),
    ], kinds=["double", "double"])
    check(apply, numbers.final_discount, [(("15%", 1.0, 2.0), 15.0), ((None, 1.0, 2.0), 50.0)], kinds=["string", "double", "double"])
    check(apply, numbers.currency, [((None, None), "EGP"), (("$5", "x"), "EGP")])


def test_device_type(apply):
    check(apply, classify.infer_device_type, [
        (("x", "android tablet"), "Smartphone"), (("Galaxy Tab", "tablet"), "Smartphone"), (("x", "feature phone"), "Smartphone"),
        (("table", None), None), (("ipad", None), "Tablet"), ((None, None), None), (("smart tv", ""), "Television"),
        (("my_pc", None), "Laptop"), (("pc2", None), None), (("a macbook and an iphone", None), "Laptop"), (("EARBUDS!", None), "Headphone"),
    ])


def test_brand(apply):
    check(apply, lambda b, m, t: classify.infer_brand(t, b, m), [
        ((None, None, "Galaxy A1"), "Samsung"), (("Generic", None, "foo"), None), (("Zed", "Dell", "HP"), "Dell"),
        ((None, None, "Hewlett  Packard x"), "HP"), ((None, None, "one plus"), "OnePlus"), ((None, None, "xiaomi dell"), "Dell"),
        ((None, None, "hewlett-packard"), None), ((None, None, "one two plus"), None),
    ])


def test_correction(apply):
    def fix(brand, maker, title, device):
        return classify.corrected_brand(title, brand, maker, device)

    check(apply, fix, [
        (("Generic", None, "foo", None), None), (("Zed", None, "foo", None), "Zed"), (("Tablet", None, "foo", None), None),
        (("Google pixel", None, "foo", "Google pixel"), "Google"), (("Gadget", None, "x", "gadget"), None),
        (("Zed", None, "galaxy", None), "Samsung"), (("", None, "foo", "x"), None),
    ])
    check(apply, classify.corrected_device, [
        (("x", "google pixel", "Google pixel"), "Google pixel"), (("tv", None, "Laptop"), "Television"), (("x", None, " "), None),
    ])
    check(apply, lambda c: classify.has_alias(c, "HP"), [("my HP.", True), ("hpx", False)])
    check(apply, classify.is_known_brand, [("LG", True), ("", False), (None, False)])


@pytest.mark.parametrize("rules", [K.DEVICE_TERMS, K.BRAND_TERMS])
def test_best_class_equals_rule_by_rule(apply, rules):
    """Brute force: every pair of terms, tested rule by rule."""
    import re

    terms = [t for ts in rules.values() for t in ts]
    texts = [f"{a} x {b}" for a in terms for b in terms[::3]]
    expected = [
        next((n for n, ts in rules.items() if any(
            re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", s) for t in ts)), None)
        for s in texts
    ]
    assert apply(lambda c: classify.best_class(c, rules), *[(t,) for t in texts]) == expected


def test_urls(apply):
    root = K.SITE_ROOT
    check(apply, urls.normalize_url, [
        (None, ""), ("", ""), ("/dp/X", root + "/dp/X"), ("dp/X", root + "/dp/X"), ("https://o.example/x", "https://o.example/x"),
        ("//cdn.example/x", "https://cdn.example/x"), ("/r?a=1&url=%2Fdp%2FY%3Fq", root + "/dp/Y?q"), ("/r?curl=1", root + "/r?curl=1"),
        ("/r?url=a+b", root + "/a b"), ("?q=1", root + "?q=1"),
    ])
    check(apply, urls.canonical_url, [(" B0 ", root + "/-/en/dp/B0"), ("", ""), (None, "")])
    check(apply, lambda a, u: urls.identity(a, u, F.lit(7)), [
        ((" b0x ", "/dp/1"), "asin:B0X"), (("", "/dp/1"), f"url:{root}/dp/1"), ((None, None), "row:7"),
    ])


def test_digit_table():
    assert len(numbers.FOREIGN_DIGITS) == len(numbers.ASCII_DIGITS) and "٣" in numbers.FOREIGN_DIGITS

"""Fixed values.

Every constant here has to equal a published value for results to be right: word
lists, marker sets, patterns and rule tables.  Order matters in the rule tables
(the first matching class or brand wins), so they are ordered mappings.
"""

from __future__ import annotations

# --- characters -------------------------------------------------------------
# Unicode white space, letters/digits/underscore and decimal digits, written so
# that the Java engine and RE2 read them alike.
SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"

# --- missing values ---------------------------------------------------------
PLACEHOLDER = "Info is not available now."

# Four different sets on purpose: each belongs to one step.
CLEAN_MISSING = (
    "",
    "not available",
    "unknown",
    "unknown seller",
    "nan",
    "none",
    "null",
    PLACEHOLDER.lower(),
)
SWEEP_MISSING = (
    "not available",
    "n/a",
    "na",
    "none",
    "null",
    "unknown seller",
    "unkown seller",
)
GENERIC_BRANDS = ("", "unknown", "generic", "not available", "n/a", "na", "none")
PROFILE_MISSING = ("not available", "na", "n/a", "none", "nan", "")

# --- availability -----------------------------------------------------------
SHIPPING_WORDS = ("ship", "ships", "shipping", "delivery", "deliver", "delivered")
IN_STOCK = "In Stock"
IN_STOCK_FORMS = ("instock", "available")
OUT_OF_STOCK = "Currently unavailable"
OUT_OF_STOCK_FORMS = ("outofstock", "currentlyunavailable", "unavailable")

# --- product names ----------------------------------------------------------
NAME_MAX_WORDS = 5
NAME_BREAK_WORDS = ("for", "to", "up")
NAME_TRAILING_WORDS = (
    "a", "an", "and", "as", "at", "but", "by", "for", "from",
    "in", "into", "nor", "of", "on", "onto", "or", "per",
    "so", "than", "the", "to", "up", "via", "vs", "with",
    "without", "yet",
)
NAME_SEPARATORS = r"[,:\-_]"

# --- currency ---------------------------------------------------------------
CURRENCY = "EGP"

# --- device types, first match wins -----------------------------------------
DEVICE_TERMS = {
    "Laptop": ("laptop", "notebook", "macbook", "chromebook", "computer", "pc"),
    "Smartphone": (
        "smartphone", "mobile", "phone", "iphone", "android", "galaxy",
        "foldable", "flip", "fold",
    ),
    "Tablet": ("tablet", "ipad", "tab", "surface"),
    "Feature Phone": ("feature phone", "button phone", "basic phone"),
    "Headphone": (
        "headphone", "headphones", "headset", "earbuds", "earbud",
        "earphones", "earphone",
    ),
    "Television": ("television", "tv", "smart tv", "led tv", "oled", "qled"),
}

# --- brands, first match wins -----------------------------------------------
BRAND_TERMS = {
    "Acer": ("acer",),
    "Anker": ("anker", "soundcore"),
    "Apple": ("apple", "iphone", "macbook", "airpods", "ipad"),
    "ASUS": ("asus", "rog", "vivobook", "zenbook", "tuf"),
    "Benco": ("benco",),
    "Dell": ("dell", "latitude", "inspiron", "vostro", "alienware"),
    "Fresh": ("fresh",),
    "Gionee": ("gionee",),
    "Google": ("google", "pixel"),
    "HP": ("hp", "hewlett packard", "omen", "pavilion", "victus"),
    "Huawei": ("huawei",),
    "Honor": ("honor",),
    "Infinix": ("infinix",),
    "Itel": ("itel",),
    "JBL": ("jbl",),
    "Lava": ("lava",),
    "Lenovo": ("lenovo", "thinkpad", "ideapad", "loq", "legion"),
    "LG": ("lg",),
    "Microsoft": ("microsoft", "surface"),
    "Motorola": ("motorola", "moto"),
    "MSI": ("msi",),
    "Nokia": ("nokia",),
    "OnePlus": ("oneplus", "one plus"),
    "Oppo": ("oppo",),
    "Realme": ("realme",),
    "Redmi": ("redmi",),
    "Samsung": ("samsung", "galaxy"),
    "Sony": ("sony",),
    "TCL": ("tcl",),
    "Tecno": ("tecno",),
    "Tornado": ("tornado",),
    "Toshiba": ("toshiba",),
    "UGREEN": ("ugreen",),
    "Vivo": ("vivo",),
    "Xiaomi": ("xiaomi", "mi", "poco"),
}

# --- pages ------------------------------------------------------------------
BLOCKED_MARKERS = (
    "opfcaptcha",
    "enter the characters you see below",
    "type the characters you see in this image",
    "/errors/validatecaptcha",
)
SITE_ROOT = "https://www.amazon.eg"
PRODUCT_PATH = "/-/en/dp/"
HOUSE_SELLER = "Amazon.eg"
HOUSE_SELLER_FORMS = ("amazon.eg", "amazon")
NO_TITLE = "Unknown Title"
NO_PRICE = "0"
NO_RATING = "0 out of 5 stars"
MAX_BULLETS = 8

# Spec labels looked up on a product page, in order of preference.
SPEC_LABELS = {
    "brand": ("brand",),
    "manufacturer": ("manufacturer",),
    "model_number": ("item model number", "model number", "model name"),
    "color": ("color", "colour"),
    "screen_size": ("standing screen display size", "screen size", "display size"),
    "ram_memory": ("ram", "memory size", "installed ram"),
    "storage_capacity": ("hard drive size", "memory storage capacity", "storage capacity"),
    "processor": ("processor", "cpu"),
    "gpu": ("graphics coprocessor", "graphics card", "gpu"),
    "operating_system": ("operating system",),
    "display_resolution": ("resolution", "display resolution"),
    "connectivity": ("connectivity", "wireless communication technology"),
    "product_dimensions": ("product dimensions", "package dimensions"),
    "item_weight": ("item weight", "weight"),
}

# --- limits -----------------------------------------------------------------
MAX_AGE_HOURS = 30.0
HIGH_DISCOUNT = 20

# Labels, fulfilment notes and return terms around a seller's name (fixed values).
SELLER_NOISE = (
    r"(?i)^(sold by|seller|shipper\s*/\s*seller)\s*:?\s*",
    r"(?i)\bshipper\s*/\s*seller\b\s*:?\s*",
    r"(?i)\s+and\s+fulfilled\s+by\s+amazon.*$",
    r"(?i)\s+fulfilled\s+by\s+amazon.*$",
    r"(?i)\s+returns?.*$",
)

# Page code in a link, stock texts on a page, names of the seller in script data.
PAGE_CODE = r"/(?:dp|product)/([A-Z0-9]{10})"
STOCK_PATTERNS = (
    r"(?i)(Only \d+ left in stock[^.]*\.)",
    r"(?i)(In Stock)",
    r"(?i)(Currently unavailable\.[^.]*\.)",
)
SELLER_KEYS = ("sellerName", "merchantName", "sellerDisplayName", "soldBy")

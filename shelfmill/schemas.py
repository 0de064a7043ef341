"""Column lists, record types and other fixed values shared by the package."""

from __future__ import annotations

# --------------------------------------------------------------------------
# These strings are part of the file formats and must not change.
# --------------------------------------------------------------------------

IMPORT_COLUMNS = [
    "Handle",
    "Title",
    "Body (HTML)",
    "Option1 Name",
    "Option1 Value",
    "Option2 Name",
    "Option2 Value",
    "Option3 Name",
    "Option3 Value",
    "Variant SKU",
    "Variant Price",
    "Image Src",
    "Source URL",
]

REVIEW_COLUMNS = [
    "Product Handle (URL Slug)",
    "Product Title",
    "Full Description (HTML)",
    "Option 1 Name",
    "Option 1 Value",
    "Option 2 Name",
    "Option 2 Value",
    "Option 3 Name",
    "Option 3 Value (or overflow)",
    "Variant SKU Code",
    "Price",
    "Image URL (Click to Preview)",
    "Original Source Link",
]

# Narrower export profiles of earlier file versions: import column -> review label.
PROFILES: dict[str, dict[str, str]] = {
    "full": dict(zip(IMPORT_COLUMNS, REVIEW_COLUMNS)),
    "single_axis": {
        "Handle": "Product Handle (URL Slug)",
        "Title": "Product Title",
        "Body (HTML)": "Full Description (HTML)",
        "Option1 Name": "Option Name (e.g. Size / Color / Weight)",
        "Option1 Value": "Option Value (e.g. Small / Red / 500g)",
        "Variant SKU": "Variant SKU Code",
        "Variant Price": "Price",
        "Image Src": "Image URL (Click to Preview)",
    },
    "single_axis_v1": {
        "Handle": "Product Handle (URL Slug)",
        "Title": "Product Title",
        "Body (HTML)": "Description (HTML)",
        "Option1 Name": "Option Name (e.g. Size / Color)",
        "Option1 Value": "Option Value (e.g. Small / Red)",
        "Variant SKU": "Variant SKU",
        "Variant Price": "Price",
        "Image Src": "Image URL (Click to Preview)",
    },
    "card_only": {
        "Handle": "Handle",
        "Title": "Title",
        "Body (HTML)": "Body (HTML)",
        "Variant Price": "Variant Price",
        "Image Src": "Image Src",
    },
}

DEFAULT_SELECTORS: dict[str, str] = {
    "card": (
        "[class*='product-card'], [class*='product-item'], "
        "[class*='ProductCard'], [class*='product-tile'], "
        "article[data-product], li[data-product-id], "
        "[class*='product-grid-item'], [class*='productgrid--item']"
    ),
    "link": "a",
    "title": (
        "h1, [class*='product-title'], [class*='product__title'], "
        "[class*='ProductTitle'], [itemprop='name']"
    ),
    "price": (
        "[class*='price']:not([class*='compare']):not([class*='was']), "
        "[data-price], [itemprop='price']"
    ),
    "desc": (
        "[class*='product-description'], [class*='product__description'], "
        "[class*='description__text'], #product-description, [itemprop='description']"
    ),
    "main_img": (
        "[class*='product-image'] img, [class*='product__image'] img, "
        "[class*='ProductImage'] img, .product__media img"
    ),
    "extra_imgs": (
        "[class*='product-image'] img, [class*='product__image'] img, "
        "[class*='thumbnail'] img, [class*='gallery'] img"
    ),
    "variants": (
        "select[name*='option'] option, [class*='variant'] input[type='radio'], "
        "[class*='swatch'] input"
    ),
}

IMAGE_NOISE_WORDS = [
    "placeholder", "blank", "loading", "svg+xml",
    "spinner", "transparent", "data:image", "icon",
]
IMAGE_NOISE_WORDS_V1 = ["placeholder", "blank", "loading", "svg+xml"]
MIN_IMAGE_WIDTH = 80

OPTION_PLACEHOLDERS = [
    "", "choose", "select", "pick",
    "choose an option", "select an option", "please select",
]

IMAGE_ATTRS = ["data-zoom-src", "data-large-src", "data-src", "src"]
IMAGE_ATTRS_V1 = ["src", "data-src", "data-zoom-src", "data-large-src"]
LINK_ATTRS = ["href", "data-href", "data-url"]
CARD_LINK_ATTRS = ["data-url", "data-href"]
CARD_IMAGE_ATTRS = ["src", "data-src"]

DEFAULT_PRICE = "0.00"
DEFAULT_TITLE = "Untitled Product"
DEFAULT_OPTION_NAME = "Title"
DEFAULT_OPTION_VALUE = "Default Title"
DOM_OPTION_NAME = "Option1"
UNNAMED_OPTION = "Option"
OVERFLOW_OPTION_NAME = "Options"
AXIS_SEPARATOR = " / "
MERGED_AXIS_DEFAULT = "Default"
FORM_ATTRIBUTE_PREFIXES = ["attribute_pa_", "attribute_"]

NO_DESCRIPTION_HTML = "<p>No description available.</p>"
IMAGE_LINK_LABEL = "View Image"
SOURCE_LINK_LABEL = "View Original"

CDN_HOST = "shopify.com"
CDN_SIZE_SUFFIXES = [
    r"_\d+x\d*(?=\.[a-z]{3,4}(\?|$))",
    r"_x\d+(?=\.[a-z]{3,4}(\?|$))",
]

# Where a crawl stores the page globals that may hold a product record.
PRODUCT_GLOBAL_PATHS = ["$.ShopifyAnalytics.meta.product", "$.__st.p"]

DEFAULT_LIMIT = 1000
DEFAULT_PAGE_START = 1
DEFAULT_PAGE_END = 50
REVIEW_SUFFIX = "_client_review"

# --------------------------------------------------------------------------
# Record types
# --------------------------------------------------------------------------

VARIANT_FIELDS = [
    "opt1_name", "opt1_value", "opt2_name", "opt2_value",
    "opt3_name", "opt3_value", "sku", "price",
]
VARIANT = "struct<" + ",".join(f"{f}:string" for f in VARIANT_FIELDS) + ">"

# One element of a parsed page. ``last`` is the document position of the last
# descendant, so the descendants of ``e`` are the positions (e.node, e.last],
# and ``a`` is an ancestor of ``e`` if a.node < e.node <= a.last.
ELEMENT = (
    "struct<node:int,parent:int,last:int,tag:string,"
    "attrs:map<string,string>,text_from:int,text_to:int,html_from:int,html_to:int>"
)
PARSED_PAGE = f"struct<els:array<{ELEMENT}>,texts:array<string>>"

PAGE_COLUMNS = {
    "page_id": "bigint",
    "url": "string",
    "html": "string",
    "catalogue": "string",
    "page_num": "bigint",
    "status": "string",
    "fetched_at": "timestamp",
    "window_json": "string",
}

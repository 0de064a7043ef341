"""Products flattened to import rows; a narrow step without any shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.functions.text import image_link, source_link
from shelfmill.schemas import IMPORT_COLUMNS, PROFILES

# Import column -> field of the zipped variant.
_VARIANT_COLUMNS = {
    "Option1 Name": "opt1_name",
    "Option1 Value": "opt1_value",
    "Option2 Name": "opt2_name",
    "Option2 Value": "opt2_value",
    "Option3 Name": "opt3_name",
    "Option3 Value": "opt3_value",
    "Variant SKU": "sku",
    "Variant Price": "price",
}
# Import column -> product column, written on a product's first row only.
_PRODUCT_COLUMNS = {"Title": "title", "Body (HTML)": "body_html", "Source URL": "source_url"}
ORDER = ["seq", "pos"]


def n_rows(variants: Column | str = "variants", extra_images: Column | str = "extra_images") -> Column:
    """Rows a product takes: as many as variants or images, whichever is more."""
    return F.greatest(F.size(variants), F.size(extra_images) + 1)


def import_rows(products: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Import rows of each product, with ``seq`` and ``pos`` for ordering.

    Variants and images are paired by position; the shorter side is padded, so
    surplus images give image-only rows.
    """
    images = F.concat(F.array("main_image"), "extra_images")
    zipped = products.select(
        "seq",
        "handle",
        *_PRODUCT_COLUMNS.values(),
        *carry,
        F.posexplode(F.arrays_zip(F.col("variants"), images.alias("images"))).alias("pos", "item"),
    )
    blank = F.lit("")
    out: dict[str, Column] = {"Handle": F.col("handle"), "Image Src": F.col("item.images")}
    for column, field in _PRODUCT_COLUMNS.items():
        out[column] = F.when(F.col("pos") == 0, F.col(field))
    for column, field in _VARIANT_COLUMNS.items():
        out[column] = F.col(f"item.variants.{field}")
    return zipped.select(
        "seq",
        F.col("pos").cast("int").alias("pos"),
        *carry,
        *[F.coalesce(out[c], blank).alias(c) for c in IMPORT_COLUMNS],
    )


def import_columns(rows: DataFrame, profile: str = "full") -> list[str]:
    """Columns of the import file: the profile without the source link."""
    return [c for c in PROFILES[profile] if c != "Source URL" and c in rows.columns]


def review_rows(rows: DataFrame, profile: str = "full") -> DataFrame:
    """Review copy: readable labels, links as spreadsheet formulas."""
    links = {"Image Src": image_link, "Source URL": source_link} if profile == "full" else {}
    renamed = [
        (links[c](F.col(c)) if c in links else F.col(c)).alias(label)
        for c, label in PROFILES[profile].items()
    ]
    return rows.select(*[c for c in ORDER if c in rows.columns], *renamed)


def profile_rows(rows: DataFrame, profile: str) -> DataFrame:
    """Projection of import rows to one of the narrower file versions."""
    return rows.select(*[c for c in ORDER if c in rows.columns], *PROFILES[profile])

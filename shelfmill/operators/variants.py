"""Variants of a product: embedded JSON, variation form, page options.

Each source is an ``array<VARIANT>`` expression; ``pick_variants`` takes the
first source that found anything.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmill.functions.filters import real_options
from shelfmill.functions.prices import normalize_price
from shelfmill.functions.text import attribute_label, blank_to_null, first_non_blank, strip_ws
from shelfmill.functions.urls import let
from shelfmill.operators.dom import all_matches, element_text, first_match, inner_html
from shelfmill.schemas import (
    AXIS_SEPARATOR,
    DEFAULT_OPTION_NAME,
    DEFAULT_OPTION_VALUE,
    DOM_OPTION_NAME,
    MERGED_AXIS_DEFAULT,
    OVERFLOW_OPTION_NAME,
    PRODUCT_GLOBAL_PATHS,
    UNNAMED_OPTION,
    VARIANT,
    VARIANT_FIELDS,
)

_PRODUCT = "options array<string>, variants array<string>"
_FORM = "array<string>"
# One parse per JSON object; nested values stay JSON text.
_OBJECT = "map<string,string>"


def _text(value: Column | str) -> Column:
    column = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("string"), F.lit(""))


def make_variant(base_price: Column, **fields: Column | str) -> Column:
    """VARIANT struct; fields left out are blank, a blank price is the base price."""
    values = {name: _text(fields.get(name, "")) for name in VARIANT_FIELDS}
    values["price"] = F.coalesce(blank_to_null(values["price"]), _text(base_price))
    return F.struct(*[values[name].alias(name) for name in VARIANT_FIELDS])


def _until_broken(objects: Column, is_good, build) -> Column:
    """Struct of the items built from the objects before the first bad one,
    and whether there is a bad one."""

    def counted(found: Column) -> Column:
        bad = F.array_position(F.transform(found, lambda o: ~is_good(o)), True)
        n = F.when(bad > 0, bad - 1).otherwise(F.size(found)).cast("int")
        return F.struct(
            F.transform(F.slice(found, F.lit(1), n), build).alias("items"), (bad > 0).alias("broken")
        )

    return let(objects, counted)


def _json_price(fields: Column, name: str, base_price: Column) -> Column:
    """Price among the fields of a JSON object; an absent field counts as the
    base price, a null is no price."""
    present = F.coalesce(F.map_contains_key(fields, name), F.lit(False))
    raw = F.when(present, fields[name]).otherwise(base_price)
    return normalize_price(raw, base_price)


def _option_name(option: Column) -> Column:
    named = first_non_blank(
        F.get_json_object(option, "$.name"),
        F.get_json_object(option, "$.label"),
        default=UNNAMED_OPTION,
    )
    return F.when(option.startswith("{"), named).otherwise(
        first_non_blank(option, default=UNNAMED_OPTION)
    )


def _product_options(product: Column) -> Column:
    names = F.transform(product.options, _option_name)
    return F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(DEFAULT_OPTION_NAME)))


def _axis_name(names: Column, axis: int) -> Column:
    return F.coalesce(F.get(names, F.lit(axis - 1)), F.lit(""))


def _labelled(names: Column, values: Column) -> Column:
    """``name:value`` items joined, blank values left out."""
    pairs = F.zip_with(
        names, values, lambda n, v: F.when(v != "", F.concat(n, F.lit(":"), v))
    )
    return F.array_join(F.filter(pairs, lambda p: p.isNotNull()), AXIS_SEPARATOR)


def _product_source(
    product_json: Column, base_price: Column, strict: bool = False
) -> Column:
    """Variants of an embedded product record, up to three option axes.

    With more than three axes the rest is joined into axis three under the
    name ``Options``. ``strict`` joins axes four and up only, which loses the
    own value of axis three; the default keeps it.
    """
    first_joined = 4 if strict else 3

    def one_variant(names: Column, fields: Column) -> Column:
        value = lambda axis: _text(fields[f"option{axis}"])
        joined_names = F.slice(names, first_joined, F.size(names) - (first_joined - 1))
        joined_values = F.transform(
            joined_names,
            lambda _n, i: _text(
                fields[F.concat(F.lit("option"), (i + first_joined).cast("string"))]
            ),
        )
        overflow = F.size(names) > 3
        return make_variant(
            base_price,
            opt1_name=_axis_name(names, 1),
            opt1_value=value(1),
            opt2_name=_axis_name(names, 2),
            opt2_value=value(2),
            opt3_name=F.when(overflow, F.lit(OVERFLOW_OPTION_NAME)).otherwise(
                _axis_name(names, 3)
            ),
            opt3_value=F.when(overflow, _labelled(joined_names, joined_values)).otherwise(
                value(3)
            ),
            sku=fields["sku"],
            price=_json_price(fields, "price", base_price),
        )

    def all_variants(product: Column) -> Column:
        return let(
            _product_options(product),
            lambda names: _until_broken(
                F.transform(product.variants, lambda v: F.from_json(v, _OBJECT)),
                lambda fields: fields.isNotNull(),
                lambda fields: one_variant(names, fields),
            ),
        )

    return let(F.from_json(product_json, _PRODUCT), all_variants)


def product_json_variants(product_json: Column, base_price: Column, strict: bool = False) -> Column:
    """Variants of an embedded product record, up to one that is no object."""
    return _product_source(product_json, base_price, strict)["items"]


def _form_source(form_json: Column, base_price: Column) -> Column:
    """Variants of a variation form: attributes one and two keep their axis,
    later attributes are joined under ``Options``."""

    def is_good(fields: Column) -> Column:
        given = F.coalesce(F.map_contains_key(fields, "attributes"), F.lit(False))
        return fields.isNotNull() & (~given | F.from_json(fields["attributes"], _OBJECT).isNotNull())

    def one_variant(fields: Column) -> Column:
        entries = F.transform(
            F.map_entries(F.from_json(fields["attributes"], _OBJECT)),
            lambda e: F.struct(
                attribute_label(e.key).alias("name"), _text(e.value).alias("value")
            ),
        )

        def build(axes: Column) -> Column:
            axis = lambda i: F.get(axes, F.lit(i - 1))
            n = F.coalesce(F.size(axes), F.lit(0))
            rest = F.slice(axes, 3, F.greatest(F.size(axes) - 2, F.lit(0)))
            joined = F.array_join(
                F.transform(rest, lambda a: F.concat(a["name"], F.lit(":"), a.value)),
                AXIS_SEPARATOR,
            )
            return make_variant(
                base_price,
                opt1_name=F.when(n > 0, axis(1)["name"]).otherwise(F.lit(UNNAMED_OPTION)),
                opt1_value=axis(1).value,
                opt2_name=axis(2)["name"],
                opt2_value=axis(2).value,
                opt3_name=F.when(n > 2, F.lit(OVERFLOW_OPTION_NAME)),
                opt3_value=F.when(n > 2, joined),
                sku=fields["sku"],
                price=_json_price(fields, "display_price", base_price),
            )

        return let(entries, build)

    objects = F.transform(F.from_json(form_json, _FORM), lambda v: F.from_json(v, _OBJECT))
    return _until_broken(objects, is_good, one_variant)


def variation_form_variants(form_json: Column, base_price: Column) -> Column:
    """Variants of a variation form, up to one that is no object or whose
    attributes are none."""
    return _form_source(form_json, base_price)["items"]


def option_variants(values: Column, base_price: Column) -> Column:
    """Variants from the option values a page offers."""
    return F.transform(
        real_options(values),
        lambda v: make_variant(base_price, opt1_name=DOM_OPTION_NAME, opt1_value=v),
    )


def default_variants(base_price: Column) -> Column:
    return F.array(
        make_variant(
            base_price, opt1_name=DEFAULT_OPTION_NAME, opt1_value=DEFAULT_OPTION_VALUE
        )
    )


def pick_variants(sources: list[Column], base_price: Column) -> Column:
    """First non-empty source as a whole, else the default variant."""
    non_empty = [let(s, lambda v: F.when(F.size(v) > 0, v)) for s in sources]
    return F.coalesce(*non_empty, default_variants(base_price))


def fall_through(sources: list[Column], options: Column, base_price: Column) -> Column:
    """First source that found anything without breaking off.

    What a source found before it broke off stays in front of the next one's
    variants. ``sources`` are structs of ``items`` and ``broken``.
    """
    none = F.array().cast(f"array<{VARIANT}>")

    def rest(left: list[Column], kept: Column) -> Column:
        if not left:
            found = F.concat(kept, F.coalesce(options, none))
            return let(found, lambda v: F.when(F.size(v) > 0, v).otherwise(default_variants(base_price)))

        def one(source: Column) -> Column:
            found = F.concat(kept, F.coalesce(source["items"], none))
            done = (F.size(source["items"]) > 0) & ~source["broken"]
            return F.when(done, found).otherwise(let(found, lambda v: rest(left[1:], v)))

        return let(left[0], one)

    return let(none, lambda empty: rest(sources, empty))


def embedded_product_json(
    els: Column | str = "els", html: Column | str = "html", window_json: Column | None = None
) -> Column:
    """Product record of a page: recorded globals first, then the first JSON
    script with variants."""
    scripts = all_matches("script[type='application/json'], script[id*='product']", els)
    bodies = F.transform(scripts, lambda s: strip_ws(inner_html(s, html)))
    with_variants = F.filter(
        bodies,
        lambda b: b.startswith("{")
        & F.coalesce(F.size(F.from_json(b, _PRODUCT).variants) > 0, F.lit(False)),
    )
    script = F.get(with_variants, F.lit(0))
    if window_json is None:
        return script
    recorded = [F.get_json_object(window_json, path) for path in PRODUCT_GLOBAL_PATHS]
    return F.coalesce(*recorded, script)


def variation_form_json(els: Column | str = "els") -> Column:
    raw = first_match("form.variations_form", els).attrs["data-product_variations"]
    return F.when(strip_ws(raw).startswith("["), raw)


def option_values(selector: str, els: Column | str = "els", texts: Column | str = "texts") -> Column:
    return F.transform(
        all_matches(selector, els),
        lambda e: strip_ws(F.coalesce(blank_to_null(e.attrs["value"]), element_text(e, texts))),
    )


def page_variants(
    selectors: dict[str, str],
    base_price: Column,
    window_json: Column | None = None,
    strict: bool = False,
) -> Column:
    """Variants of a parsed page row (columns ``els``, ``texts``, ``html``)."""
    return fall_through(
        [
            let(
                embedded_product_json(window_json=window_json),
                lambda j: _product_source(j, base_price, strict),
            ),
            _form_source(variation_form_json(), base_price),
        ],
        option_variants(option_values(selectors["variants"]), base_price),
        base_price,
    )


def merge_axes(variants: Column, title: Column | None = None) -> Column:
    """Older single-axis form: the option values joined into axis one."""

    def merged(v: Column) -> Column:
        own = F.array_join(
            F.filter(
                F.array(v.opt1_value, v.opt2_value, v.opt3_value),
                lambda x: F.coalesce(x, F.lit("")) != "",
            ),
            AXIS_SEPARATOR,
        )
        fallbacks = [own] if title is None else [own, title]
        return make_variant(
            v.price,
            opt1_name=v.opt1_name,
            opt1_value=first_non_blank(*fallbacks, default=MERGED_AXIS_DEFAULT),
            sku=v.sku,
            price=v.price,
        )

    return F.transform(variants, merged)

"""Text expressions: stripping, handles, tag removal, description HTML, links.

Every function takes a column (or column name) and returns a JVM-side
expression, so all of them stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmill.schemas import (
    FORM_ATTRIBUTE_PREFIXES,
    IMAGE_LINK_LABEL,
    NO_DESCRIPTION_HTML,
    SOURCE_LINK_LABEL,
)

# Unicode white space plus the four ASCII separators Java's \s leaves out.
WS = r"[\s\x1c-\x1f]"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(as_col(value), F.lit(""))


def first_non_blank(*values: Column | str, default: str = "") -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[blank_to_null(v) for v in values], F.lit(default))


def strip_ws(value: Column | str) -> Column:
    """Strip Unicode white space at both ends.

    The look-behind lets a trailing run be tried once, from its first
    character, which keeps long inner runs linear; it is looked at behind that
    character only, so most places cost one test.
    """
    return F.regexp_replace(as_col(value), rf"(?U)\A{WS}++|{WS}(?<!{WS}{WS}){WS}*+\z", "")


def squeeze_ws(value: Column | str) -> Column:
    """Runs of Unicode white space as one space, none at the ends; single spaces are left in place."""
    return F.trim(F.regexp_replace(as_col(value), rf"(?U)[{WS}&&[^ ]]{WS}*+| {WS}++", " "))


def slugify(title: Column | str) -> Column:
    """URL handle of a title: runs outside [a-z0-9] become one dash."""
    dashed = F.regexp_replace(F.lower(as_col(title)), "[^a-z0-9]+", "-")
    return F.trim(dashed, F.lit("-"))


def card_handle(title: Column | str, seq: Column | str) -> Column:
    """Handle of a card; untitled cards are named after their place, ``seq``."""
    t = as_col(title)
    return F.when(F.coalesce(t, F.lit("")) != "", slugify(t)).otherwise(
        F.concat(F.lit("item-"), as_col(seq).cast("string"))
    )


def strip_tags(inner_html: Column | str) -> Column:
    """Text of an HTML fragment; a fragment without text is returned itself.

    No tag ends behind the last ">", so the pattern is kept off that tail,
    where every "<" would make it read to the end again.
    """
    html = strip_ws(inner_html)
    tail = F.substring_index(html, ">", -1)
    tagged = F.substring(html, F.lit(1), F.length(html) - F.length(tail))
    text = squeeze_ws(F.concat(F.regexp_replace(tagged, "<[^>]+>", " "), tail))
    return F.coalesce(blank_to_null(text), html)


def fallback_html(text: Column | str) -> Column:
    """Paragraph markup for a description nobody formatted."""
    raw = as_col(text)
    split = F.replace(raw, F.lit("\n\n"), F.lit("</p><p>"))
    flat = F.replace(split, F.lit("\n"), F.lit(" "))
    return F.when(is_blank(raw), F.lit(NO_DESCRIPTION_HTML)).otherwise(
        F.concat(F.lit("<p>"), flat, F.lit("</p>"))
    )


def is_blank(text: Column | str) -> Column:
    return F.coalesce(strip_ws(text), F.lit("")) == ""


def clean_response(response: Column | str) -> Column:
    """Remove a surrounding code fence from a formatter's answer."""
    bare = F.regexp_replace(strip_ws(response), r"\A```[a-z]*\n?", "")
    return strip_ws(F.regexp_replace(bare, r"\n?```\z", ""))


def prompt(text: Column | str, instructions: str) -> Column:
    return F.concat(F.lit(instructions), as_col(text))


def attribute_label(key: Column | str) -> Column:
    """Readable option name: prefixes dropped, every letter run capitalised."""
    label = as_col(key)
    for prefix in FORM_ATTRIBUTE_PREFIXES:
        label = F.replace(label, F.lit(prefix), F.lit(""))
    runs = F.regexp_extract_all(label, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, F.initcap), "")


def hyperlink(url: Column | str, label: str) -> Column:
    """Spreadsheet link formula; quotes in the URL are percent-encoded."""
    u = as_col(url)
    safe = F.replace(u, F.lit('"'), F.lit("%22"))
    return F.when(
        u.startswith("http"),
        F.concat(F.lit('=HYPERLINK("'), safe, F.lit(f'","{label}")')),
    ).otherwise(u)


def image_link(url: Column | str) -> Column:
    return hyperlink(url, IMAGE_LINK_LABEL)


def source_link(url: Column | str) -> Column:
    return hyperlink(url, SOURCE_LINK_LABEL)

"""URL expressions: reference resolution, image clean-up, srcset choice.

Resolution follows RFC 3986 and is built from split/filter/aggregate, so no
Python worker is involved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmill.functions.text import as_col, blank_to_null, strip_ws
from shelfmill.schemas import CDN_HOST, CDN_SIZE_SUFFIXES

# scheme, authority, path, path parameters, query, fragment (RFC 3986 app. B)
_PARTS = (
    r"(?s)\A(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?"
    r"((?:[^?#]*/)?[^;/?#]*)(;[^?#]*)?(\?[^#]*)?(#.*)?\z"
)
_SCHEME, _AUTHORITY, _PATH, _PARAMS, _QUERY, _FRAGMENT = range(6)
_MARK = "\x01"
# Plain addresses and references, without dot or blank segments, parameters or escapes.
_SEGMENT = r"[A-Za-z0-9_~=\-][A-Za-z0-9_.~=\-]*+"
_PLAIN_BASE = rf"\Ahttps?://[A-Za-z0-9.:\-]++(?:/{_SEGMENT})*+/?+\z"
_PLAIN_REFERENCE = rf"\A(?:\.\./|/)?+{_SEGMENT}(?:/{_SEGMENT})*+/?+(?:\?[A-Za-z0-9_.~=&\-]++)?+\z"
_HIERARCHICAL = ["", "http", "https", "ftp", "sftp", "file"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    A one-element transform binds it to a lambda variable, which keeps large
    expressions linear where the optimizer cannot share subexpressions.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _split_url(url: Column) -> Column:
    """The six parts of a URL, by one pass of the pattern."""
    # Browsers and RFC parsers ignore leading controls and inner tab/newline.
    tidy = F.regexp_replace(url, rf"\A[\x00-\x20]+|[\t\r\n{_MARK}]", "")
    marked = F.regexp_replace(tidy, _PARTS, _MARK.join(f"${i}" for i in range(1, 7)))
    return F.split(marked, _MARK)


def _dot_free(segments: Column) -> Column:
    """Resolve ``.`` and ``..`` in a list of path segments."""
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        )
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    full = F.when(ends_in_dots, F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.coalesce(blank_to_null(F.array_join(full, "/")), F.lit("/"))


def _drop_inner_blanks(segments: Column) -> Column:
    n = F.size(segments)
    return F.filter(segments, lambda s, i: (s != "") | (i == 0) | (i == n - 1))


def _merged_path(href_path: Column, base_path: Column) -> Column:
    base_dir = F.split(F.regexp_replace(base_path, r"[^/]+\z", ""), "/")
    # "a/b/" splits to [a, b, ""]: the final blank is the slot of the new name.
    dir_only = F.when(
        F.size(base_dir) > 1, F.slice(base_dir, 1, F.size(base_dir) - 1)
    ).otherwise(base_dir)
    own = F.split(href_path, "/")
    merged = let(F.concat(dir_only, own), _drop_inner_blanks)
    segments = F.when(href_path.startswith("/"), own).otherwise(merged)
    return let(segments, _dot_free)


def _unless_bare(part: Column, mark: str) -> Column:
    return F.when(part == mark, F.lit("")).otherwise(part)


def _join_parts(h: Column, b: Column) -> Column:
    """Reference parts ``h`` combined with base parts ``b``."""
    base_path, own_path = b[_PATH], h[_PATH]
    has_path = (own_path != "") | (h[_PARAMS] != "")
    path = F.when(has_path, _merged_path(own_path, base_path)).otherwise(base_path)
    # After an authority a path starts with a slash.
    unrooted = F.when(b[_AUTHORITY] != "", r"\A(?=[^/])").otherwise(r"\A(?!)")
    path = F.regexp_replace(path, unrooted, F.lit("/"))
    params = _unless_bare(F.when(has_path, h[_PARAMS]).otherwise(b[_PARAMS]), ";")
    own_query = _unless_bare(h[_QUERY], "?")
    query = F.when(has_path | (own_query != ""), own_query).otherwise(
        _unless_bare(b[_QUERY], "?")
    )
    scheme = F.when(
        b[_SCHEME] != "", F.concat(F.lower(b[_SCHEME]), F.lit(":"))
    ).otherwise("")
    rest = F.when(
        h[_AUTHORITY] != "",
        F.concat(h[_AUTHORITY], own_path, _unless_bare(h[_PARAMS], ";"), own_query),
    ).otherwise(F.concat(b[_AUTHORITY], path, params, query))
    return F.concat(scheme, rest, _unless_bare(h[_FRAGMENT], "#"))


def _plain_url(h: Column, b: Column) -> Column:
    """A plain reference seen on a plain page by cutting the page's address; null for any other."""

    def folder(url: Column) -> Column:
        return F.substring_index(url, "/", -1)

    def cut(url: Column) -> Column:
        """The address up to its last slash, without it; null where that leaves the host alone or less."""
        rest = F.left(url, F.length(url) - F.length(folder(url)) - 1)
        return F.when(F.length(rest) - F.length(F.replace(rest, F.lit("/"), F.lit(""))) > 1, rest)

    origin = F.substring_index(b, "/", 3)
    above = let(cut(b), lambda at: F.concat(cut(at), F.substring(h, F.lit(3), F.length(h))))
    beside = F.concat(cut(b), F.lit("/"), h)
    joined = F.when(h.startswith("/"), F.concat(origin, h)).when(h.startswith("../"), above).otherwise(beside)
    return F.when(h.rlike(_PLAIN_REFERENCE) & b.rlike(_PLAIN_BASE), joined)


def resolve_url(href: Column | str, base: Column | str) -> Column:
    """Absolute form of ``href`` seen on page ``base``; blank stays blank.

    Plain references take a short way, without taking both addresses apart.
    """
    h, b = as_col(href), F.coalesce(as_col(base), F.lit(""))

    def joined(p: Column) -> Column:
        own, its = F.lower(p.h[_SCHEME]), F.lower(p.b[_SCHEME])
        same_scheme = (own == "") | (own == its)
        known = its.isin(_HIERARCHICAL)
        return F.when(same_scheme & known, _join_parts(p.h, p.b)).otherwise(h)

    relative = let(
        F.struct(_split_url(h).alias("h"), _split_url(b).alias("b")), joined
    )
    return (
        F.when(F.coalesce(h, F.lit("")) == "", F.lit(""))
        .when(h.startswith("http"), h)
        .when(h.startswith("//"), F.concat(F.lit("https:"), h))
        .when(b == "", h)
        .otherwise(F.coalesce(_plain_url(h, b), relative))
    )


def resolve_root_url(href: Column | str, base: Column | str) -> Column:
    """Older rule: only root-relative references are completed."""
    h = as_col(href)
    origin = F.regexp_extract(as_col(base), r"\A(\w+://[^/?#]*)", 1)
    return (
        F.when(F.coalesce(h, F.lit("")) == "", F.lit(""))
        .when(h.startswith("http"), h)
        .when(h.startswith("//"), F.concat(F.lit("https:"), h))
        .when(h.startswith("/"), F.concat(origin, h))
        .otherwise(h)
    )


def clean_image_url(url: Column | str) -> Column:
    u = F.coalesce(as_col(url), F.lit(""))
    return F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).otherwise(u)


def full_size_url(url: Column | str, host: str = CDN_HOST) -> Column:
    """Drop the size suffix that an image CDN appends to file names."""
    u = as_col(url)
    full = u
    for suffix in CDN_SIZE_SUFFIXES:
        full = F.regexp_replace(full, suffix, "")
    return F.when(F.contains(u, F.lit(host)), full).otherwise(u)


def srcset_best(srcset: Column | str) -> Column:
    """Widest candidate of a srcset; the first wins a tie.

    Density entries (``2x``) are ignored. A bare URL replaces the choice so
    far without changing the width to beat.
    """
    entries = F.transform(
        F.split(F.coalesce(as_col(srcset), F.lit("")), ","),
        lambda e: F.split(strip_ws(e), r"(?U)[\s\x1c-\x1f]+"),
    )
    start = F.struct(F.lit("").alias("url"), F.lit(0).cast("bigint").alias("width"))

    def step(best: Column, parts: Column) -> Column:
        url = F.get(parts, F.lit(0))
        width = F.regexp_extract(
            F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\A([+-]?\d+)w*\z", 1
        ).try_cast("bigint")
        is_bare = (F.size(parts) == 1) & (url != "")
        return (
            F.when(is_bare, F.struct(url.alias("url"), best.width.alias("width")))
            .when(width > best.width, F.struct(url.alias("url"), width.alias("width")))
            .otherwise(best)
        )

    best = F.aggregate(entries, start, step, lambda best: best.url)
    return F.when(F.coalesce(as_col(srcset), F.lit("")) == "", F.lit("")).otherwise(best)

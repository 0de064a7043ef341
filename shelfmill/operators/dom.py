"""Parsed pages and selector predicates.

``parse_pages`` is the one Python stage. It turns the HTML of each page into
two arrays that stay in the page's own row:

* ``els``   - the elements in document order (see ``schemas.ELEMENT``),
* ``texts`` - the visible text pieces in document order.

Elements refer to their text and markup by position instead of carrying a
copy, so a parsed page stays linear in the size of its HTML. Because a page is
one row, matching, scoping and text extraction are array expressions without
any shuffle; ``elements`` explodes them to a flat table where one is wanted.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.functions.text import first_non_blank, squeeze_ws
from shelfmill.functions.urls import let
from shelfmill.operators.page_builder import parse_batch
from shelfmill.schemas import DEFAULT_SELECTORS, PARSED_PAGE
from shelfmill.session import spread


def parse_pages(pages: DataFrame) -> DataFrame:
    """Add ``els`` and ``texts`` to a page table; both are null for a reject.

    Only ``html`` travels to the Python workers. The call is marked
    nondeterministic so that Catalyst never evaluates it twice for a filter.
    """
    parse = F.arrow_udf(parse_batch, PARSED_PAGE).asNondeterministic()
    others = [c for c in pages.columns if c not in ("els", "texts")]
    return spread(pages).withColumn("_parsed", parse(F.col("html"))).select(
        *others, F.col("_parsed.els").alias("els"), F.col("_parsed.texts").alias("texts")
    )


def page_rejects(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("els").isNull()).select("page_id", "url")


# --------------------------------------------------------------------------
# Selectors
# --------------------------------------------------------------------------
_SIMPLE = re.compile(
    r"""(?P<tag>\*|[A-Za-z][\w-]*)
      | \.(?P<cls>[\w-]+)
      | \#(?P<id>[\w-]+)
      | \[\s*(?P<attr>[\w-]+)\s*(?:(?P<op>\*?=)\s*(?P<quote>['"])(?P<value>.*?)(?P=quote)\s*)?\]
      | :not\(\[\s*(?P<nattr>[\w-]+)\s*\*=\s*(?P<nquote>['"])(?P<nvalue>.*?)(?P=nquote)\s*\]\)""",
    re.VERBOSE,
)
_COMBINATOR = re.compile(r"\s*>\s*|\s+")


def _read_selector(selector: str) -> list[list]:
    """Alternatives of a selector, each a list of (combinator, simple tests)."""
    alternatives, at, text = [], 0, selector.strip()
    chain, tests, combinator = [], [], ""

    def fail():
        raise ValueError(f"unsupported selector {selector!r} at position {at}")

    def end_compound():
        if not tests:
            fail()
        chain.append((combinator, list(tests)))
        tests.clear()

    while at < len(text):
        comma = re.match(r"\s*,\s*", text[at:])
        if comma:
            end_compound()
            alternatives.append(list(chain))
            chain.clear()
            combinator, at = "", at + comma.end()
            continue
        simple = _SIMPLE.match(text, at)
        if simple and not (simple["tag"] and tests):
            tests.append(simple.groupdict())
            at = simple.end()
            continue
        gap = _COMBINATOR.match(text, at)
        if not gap:
            fail()
        end_compound()
        combinator = ">" if ">" in gap.group() else " "
        at = gap.end()
    end_compound()
    return alternatives + [chain]


def _simple_test(e: Column, test: dict) -> Column:
    attr = lambda name: e.attrs[name]
    if test["tag"]:
        return F.lit(True) if test["tag"] == "*" else e.tag == test["tag"].lower()
    if test["cls"]:
        padded = F.concat(F.lit(" "), F.translate(attr("class"), "\t\n\r\f", "    "), F.lit(" "))
        return F.contains(padded, F.lit(f" {test['cls']} "))
    if test["id"]:
        return attr("id") == test["id"]
    if test["attr"] and not test["op"]:
        return attr(test["attr"].lower()).isNotNull()
    if test["attr"] and test["op"] == "=":
        return attr(test["attr"].lower()) == test["value"]
    if test["attr"]:
        # An empty substring matches nothing, as the selector standard says.
        return F.contains(attr(test["attr"].lower()), F.lit(test["value"])) & F.lit(
            test["value"] != ""
        )
    return ~F.coalesce(
        F.contains(attr(test["nattr"].lower()), F.lit(test["nvalue"])), F.lit(False)
    )


def _ancestor_chains(chains: list[list]) -> list[list]:
    """What stands left of each descendant combinator, inner parts first."""
    found: list[list] = []
    for chain in chains:
        for k in range(1, len(chain)):
            if chain[k][0] == " " and chain[:k] not in found:
                found.append(chain[:k])
    return sorted(found, key=len)


def _chain_matches(chain: list, e: Column, els: Column, above: dict[str, Column]) -> Column:
    """``above`` holds, for each ancestor chain, the page's elements that fit it."""
    combinator, tests = chain[-1]
    here = functools.reduce(
        lambda one, other: one & other, [_simple_test(e, t) for t in tests]
    )
    if len(chain) == 1:
        return here
    rest = chain[:-1]
    if combinator == ">":
        return here & (e.parent >= 0) & _chain_matches(
            rest, F.get(els, e.parent), els, above
        )
    return here & F.exists(above[repr(rest)], lambda a: (a.node < e.node) & (a["last"] >= e.node))


def _substring_test(chain: list) -> tuple[str, str] | None:
    """(attribute, value) of an alternative that is one ``[a*='v']`` test."""
    tests = chain[0][1]
    if len(chain) == 1 and len(tests) == 1 and tests[0]["op"] == "*=" and tests[0]["value"]:
        return tests[0]["attr"].lower(), tests[0]["value"]
    return None


def _matches(chains: list[list], e: Column, els: Column, above: dict[str, Column]) -> Column:
    """Predicate: element ``e`` of the page elements ``els`` fits a selector.

    Supported: tag, ``.class``, ``#id``, ``[a]``, ``[a='v']``, ``[a*='v']``,
    ``:not([a*='v'])``, compounds, descendant, child ``>`` and comma lists.
    Anything else raises ``ValueError``. The predicate may be null for an
    element that does not fit, which filters treat as false.
    """
    # Substring alternatives on one attribute share one lookup and one pattern.
    shared: dict[str, list[str]] = {}
    tests = []
    for chain in chains:
        simple = _substring_test(chain)
        if simple:
            shared.setdefault(simple[0], []).append(re.escape(simple[1]))
        else:
            tests.append(_chain_matches(chain, e, els, above))
    tests += [e.attrs[name].rlike("|".join(values)) for name, values in shared.items()]
    return functools.reduce(lambda one, other: one | other, tests)


def all_matches(selector: str, els: Column | str = "els", within: Column | None = None) -> Column:
    """Matching elements in document order, of the page or of a scope.

    ``within`` is an array of candidate elements, e.g. from ``descendants``;
    ancestors are still looked up in the whole page.
    """
    page = F.col(els) if isinstance(els, str) else els
    chains = _read_selector(selector)

    def found(left: list[list], above: dict[str, Column]) -> Column:
        """Elements that fit each ancestor chain are picked once, then the selector's."""
        if not left:
            return F.filter(
                page if within is None else within, lambda e: _matches(chains, e, page, above)
            )
        fitting = F.filter(page, lambda e: _chain_matches(left[0], e, page, above))
        return let(fitting, lambda fit: found(left[1:], {**above, repr(left[0]): fit}))

    return found(_ancestor_chains(chains), {})


def first_match(selector: str, els: Column | str = "els", within: Column | None = None) -> Column:
    """Earliest matching element in document order, whatever the list order."""
    return F.get(all_matches(selector, els, within), F.lit(0))


def descendants(e: Column, els: Column | str = "els") -> Column:
    """Strict descendants of ``e``; contiguous because of document order."""
    page = F.col(els) if isinstance(els, str) else els
    return F.slice(page, e.node + 2, e["last"] - e.node)


def element_text(e: Column, texts: Column | str = "texts") -> Column:
    """Visible text of an element with white space collapsed."""
    pieces = F.col(texts) if isinstance(texts, str) else texts

    def text(x: Column) -> Column:
        own = F.slice(pieces, x.text_from + 1, x.text_to - x.text_from)
        return squeeze_ws(F.array_join(own, ""))

    return let(e, text)


def inner_html(e: Column, html: Column | str = "html") -> Column:
    page = F.col(html) if isinstance(html, str) else html
    return let(e, lambda x: F.substring(page, x.html_from + 1, x.html_to - x.html_from))


def first_attr(e: Column, names: list[str]) -> Column:
    """First non-empty attribute in the given order, else the empty string."""
    return let(e.attrs, lambda attrs: first_non_blank(*[attrs[n] for n in names]))


def build_selectors(overrides: dict[str, str | None] | None = None) -> dict[str, str]:
    """Default selectors with non-empty overrides applied."""
    given = {k: v for k, v in (overrides or {}).items() if v}
    unknown = set(given) - set(DEFAULT_SELECTORS)
    if unknown:
        raise ValueError(f"unknown selector names: {sorted(unknown)}")
    return {**DEFAULT_SELECTORS, **given}


# --------------------------------------------------------------------------
# Tables derived from parsed pages
# --------------------------------------------------------------------------
def explode_records(df: DataFrame, records: str, *keep: str | Column) -> DataFrame:
    """One row per array item, with its position and the item's fields.

    The outer form is used because Catalyst infers a size filter for the inner
    one and would then compute the array expression twice.
    """
    return (
        df.select(*keep, F.posexplode_outer(records).alias("pos", "_item"))
        .where(F.col("pos").isNotNull())
        .select(*keep, "pos", "_item.*")
    )


def elements(pages: DataFrame, selector: str | None = None, content: bool = True) -> DataFrame:
    """Flat element table; optionally only elements that fit a selector.

    ``content=False`` leaves out text and markup, which repeat nested content.
    """
    parsed = pages if "els" in pages.columns else parse_pages(pages)
    els = F.col("els")
    wanted = els if selector is None else all_matches(selector)

    def row(e: Column) -> Column:
        fields = [e[f].alias(f) for f in ("node", "parent", "last", "tag", "attrs")]
        if content:
            fields += [element_text(e).alias("text"), inner_html(e).alias("inner_html")]
        return F.struct(*fields)

    found = parsed.select("page_id", F.transform(wanted, row).alias("rows"))
    return explode_records(found, "rows", "page_id").drop("pos")


def extract_records(pages: DataFrame, row_selector: str, fields: dict[str, str]) -> DataFrame:
    """One row per repeated container, one text column per scoped selector."""
    parsed = pages if "els" in pages.columns else parse_pages(pages)
    els = F.col("els")

    def record(container: Column) -> Column:
        def values(scope: Column) -> Column:
            return F.struct(
                *[
                    F.coalesce(
                        element_text(first_match(sel, els, within=scope)), F.lit("")
                    ).alias(name)
                    for name, sel in fields.items()
                ]
            )

        return let(descendants(container), values)

    records = F.transform(all_matches(row_selector), record)
    return explode_records(
        parsed.select("page_id", records.alias("records")), "records", "page_id"
    )

"""HTML pages to Arrow arrays: the part that runs inside Python workers.

The functions are pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import re
import sys
from array import array
from html import unescape
from itertools import accumulate
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# --------------------------------------------------------------------------
# Fixed values from the HTML standard
# --------------------------------------------------------------------------
VOID_TAGS = set(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN_TAGS = set("script style noscript template".split())
BLOCK_TAGS = set(
    "address article aside blockquote dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section "
    "select table tbody td tfoot th thead tr ul".split()
)
CLOSES_PARAGRAPH = BLOCK_TAGS - set("dd dt li option select tbody td tfoot th thead tr".split())
# An opening tag closes these open siblings, looking no further than the fence.
CLOSES_SIBLING = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
PARAGRAPH_FENCE = {"button", "table", "td", "th", "caption", "object"}
NO_FENCE: set[str] = set()
RAW_TEXT_TAGS = {"script", "style"}
FOREIGN_TAGS = {"svg", "math"}

# A comment or declaration, a closing tag, or an opening tag with attributes.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z) | <[!?][^>]*(?:>|\Z)
      | </([a-zA-Z][^\s/>]*)[^>]*>
      | <([a-zA-Z][^\s/>]*)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>""",
    re.VERBOSE | re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""([^\s/=>"'][^\s/=>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?"""
)

_RAW_OPEN = re.compile(r"(script|style)(?=[\s/]|\Z)")
_RAW_CLOSE = {tag: re.compile(rf"/{tag}[\s/>]", re.IGNORECASE) for tag in RAW_TEXT_TAGS}
KEPT = 1 << 16  # tags that a worker remembers
KEPT_ELEMENTS = 1 << 20  # elements of the layouts it remembers

# So many equal tags behind one another are read at once.
RUN = 8


def _repeats(html: str, tag: str, at: int) -> int:
    """How many times ``tag`` stands in a row from ``at`` on."""
    return (re.compile(f"(?:{re.escape(tag)})*+").match(html, at).end() - at) // len(tag)


def _attributes(attrs: str) -> dict[str, str]:
    own = {}
    for name, double, single, bare in _ATTRIBUTE.findall(attrs):
        value = double or single or bare
        own.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return own


def _tag(inside: str) -> tuple[str, tuple | None, tuple | None] | None:
    """What ``<inside>`` does to the tree, and the attribute names and values of an opening tag.

    None if it does not end with its first ">", or is a script or style in capitals or closed in itself.
    """
    token = _TOKEN.match(f"<{inside}>")
    if not token or inside.startswith("!--") and not (len(inside) > 4 and inside.endswith("--")):
        return None
    closing, opening, attrs = token.groups()
    if not opening:
        return ("/" + closing.lower() if closing else "!"), None, None
    tag, alone = opening.lower(), attrs.endswith("/")
    if tag in RAW_TEXT_TAGS and (alone or opening != tag):
        return None
    own = _attributes(attrs) if attrs else {}
    return tag + (">/" if alone else ">"), tuple(own), tuple(own.values())


def _with_content(parts: list[tuple]) -> list[tuple]:
    """The parts of a page, with the content of each script or style as one text."""
    found, tag = [], None
    for part in parts:
        inside, end, text = part
        if tag and not _RAW_CLOSE[tag].match(inside + end):
            found[-1][2].append(f"<{inside}{end}{text}")
            continue
        raw = _RAW_OPEN.match(inside)
        tag = raw[1] if raw else None
        found.append((inside, end, [text]))
    return [(inside, end, "".join(texts)) for inside, end, texts in found]


class Layout:
    """The tree of all pages with the same tags in the same order and text at the same places.

    ``rows`` are the ``INTS`` of the elements, with the markup positions as
    places among the ends of the page's pieces; ``texts`` picks the visible
    texts from the pieces and a line break behind them.
    """

    def __init__(self, tags: list[str], texts: list[str], names: list[str]):
        # Texts are named by their place, so that the parsed page tells where they went.
        drawn = [""] * (len(tags) + len(texts))
        drawn[::2] = [text and str(i) for i, text in enumerate(texts)]
        drawn[1::2] = [f"<{tag}>" for tag in tags]
        batch = PageBatch()
        batch._read("".join(drawn))
        place = {end: i for i, end in enumerate(accumulate(map(len, drawn)))}
        self.rows = np.array(batch.ints, np.int32).reshape(-1, len(PageBatch.INTS))
        for column in (5, 6):
            self.rows[:, column] = [place[at] for at in self.rows[:, column].tolist()]
        self.tags = batch.tags
        at = [len(texts) if text == "\n" else int(text) for text in batch.texts]
        self.texts = itemgetter(*at) if len(at) > 1 else lambda found: [found[i] for i in at]
        self.opening = [i for i, name in enumerate(names) if ">" in name]


class Memory:
    """What a worker remembers from page to page: tags and layouts."""

    def __init__(self):
        self.tags: dict[str, tuple] = {}
        self.layouts: dict[tuple, Layout | None] = {}
        self.elements = 0

    def tag(self, inside: str) -> tuple | None:
        if len(self.tags) >= KEPT:
            self.tags.clear()
        found = self.tags[inside] = _tag(inside)
        return found

    def layout(self, tags: list[str], texts: list[str], names: list[str]) -> Layout | None:
        """The layout of a page; none is made of a page that is the first of its kind."""
        key = (*names, *map(bool, texts))
        found = self.layouts.get(key)
        if found is None:
            if key in self.layouts:
                found = Layout(tags, texts, names)
            self.elements += len(names)
            if self.elements > KEPT_ELEMENTS:
                self.layouts.clear()
                self.elements = len(names)
            self.layouts[key] = found
        return found


class PageBatch:
    """Element and text columns of a batch of pages, filled page by page.

    Everything is appended to flat columns, which become Arrow arrays without
    a per-element conversion. No tree objects are kept. Pages of a layout that
    was seen before take it over; only their tags are read.
    """

    INTS = ("node", "parent", "last", "text_from", "text_to", "html_from", "html_to")

    def __init__(self, memory: Memory | None = None):
        self.memory = memory
        self.ints = array("i")  # the INTS of each element in turn, of pages that are read
        self.parts = []  # for each page its rows, or the span of ``ints`` that has them
        self.lengths, self.counts = [], []  # of texts and tags in turn, of pages with a layout
        self.tags, self.keys, self.values, self.attr_ends = [], [], [], array("i")
        self.texts = []
        self.page_ends, self.text_ends, self.missing = array("i"), array("i"), []

    def add(self, html: str | None) -> None:
        columns = [self.ints, self.tags, self.keys, self.values, self.attr_ends, self.texts]
        sizes = [len(c) for c in columns]
        failed = html is None
        if not failed:
            try:
                if not (self.memory and self._take_over(html)):
                    self._read(html)
                    self.parts.append((sizes[0], len(self.ints)))
            except Exception:  # one unreadable page becomes a reject, not a failed job
                failed = True
                for column, size in zip(columns, sizes):
                    del column[size:]
        self.missing.append(failed)
        self.page_ends.append(len(self.tags))
        self.text_ends.append(len(self.texts))

    def _take_over(self, html: str) -> bool:
        """Add a page by the layout of an earlier one, if there is one and each tag ends with its first ">"."""
        first, *parts = html.split("<")
        parts = [part.partition(">") for part in parts]
        if "<script" in html or "<style" in html:
            parts = _with_content(parts)
        if not parts:
            return False
        tags, ends, texts = zip(*parts)
        if "" in ends:
            return False
        known, learn = self.memory.tags.get, self.memory.tag
        read = [known(tag) or learn(tag) for tag in tags]
        if None in read:
            return False
        texts = [first, *texts]
        layout = self.memory.layout(tags, texts, [tag[0] for tag in read])
        if layout is None:
            return False
        keys, values, attr_ends = self.keys, self.values, self.attr_ends
        for i in layout.opening:
            _, names, own = read[i]
            if names:
                keys += names
                values += own
            attr_ends.append(len(keys))
        self.tags += layout.tags
        lengths = [0] * (len(tags) + len(texts))
        lengths[::2], lengths[1::2] = map(len, texts), map(len, tags)
        self.lengths += lengths
        self.counts.append(len(lengths))
        self.parts.append(layout.rows)
        if "&" in html:
            texts = [unescape(text) if "&" in text else text for text in texts]
        texts.append("\n")
        self.texts += layout.texts(texts)
        return True

    def _rows(self) -> np.ndarray:
        """The INTS of all elements, a row each."""
        width = len(self.INTS)
        read = np.array(self.ints, np.int32).reshape(-1, width)
        if not self.counts:
            return read
        parts = [read[p[0] // width : p[1] // width] if isinstance(p, tuple) else p for p in self.parts]
        rows, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        taken = np.array([not isinstance(p, tuple) for p in self.parts])
        of_layout = np.repeat(taken, sizes)
        # Places among the texts and tags of a page become positions; a tag has two brackets.
        ends = np.cumsum([0, *self.lengths])
        first = np.zeros(len(parts), np.int64)
        first[taken] = np.cumsum(self.counts) - self.counts
        first = np.repeat(first, sizes)[of_layout, None]
        places = rows[of_layout, 5:7]
        rows[of_layout, 5:7] = ends[first + places + 1] - ends[first] + (places + 1) // 2 * 2
        return rows

    def _read(self, html: str) -> None:
        first, first_text = len(self.tags), len(self.texts)
        tags, texts, keys, values, attr_ends = self.tags, self.texts, self.keys, self.values, self.attr_ends
        ints, width = self.ints, len(self.INTS)
        first_int = len(ints)
        open_nodes, open_tags = array("i"), []
        # Depths of the open elements of each tag, so that no step looks through all of them.
        open_at: dict[str, list[int]] = {}
        hidden = 0

        def nearest(wanted: set[str]) -> int:
            depth = -1
            for t in wanted:
                if (at := open_at.get(t)) and at[-1] > depth:
                    depth = at[-1]
            return depth

        def close(depth: int, at: int) -> None:
            nonlocal hidden
            newest = len(tags) - first - 1
            while len(open_nodes) > depth:
                node, tag = open_nodes.pop(), open_tags.pop()
                open_at[tag].pop()
                if tag in HIDDEN_TAGS:
                    hidden -= 1
                elif not hidden and tag in BLOCK_TAGS:
                    texts.append("\n")
                row = first_int + node * width
                ints[row + 2] = newest
                ints[row + 4] = len(texts) - first_text
                ints[row + 6] = at

        def close_nearest(wanted: set[str], fence: set[str], at: int) -> None:
            depth = nearest(wanted)
            if depth >= 0 and depth > nearest(fence):
                close(depth, at)

        def open_run(tag: str, n: int, at: int, length: int) -> None:
            """Open ``n`` elements, each inside the one before it, the first in the newest."""
            node, depth = len(tags) - first, len(open_tags)
            step = int(not hidden and tag in BLOCK_TAGS)
            nodes = np.arange(node, node + n, dtype=np.int32)
            rows = np.empty((n, width), np.int32)
            rows[:, 0] = rows[:, 2] = nodes
            rows[:, 1] = nodes - 1
            rows[:, 3:5] = (len(texts) - first_text + step * np.arange(1, n + 1))[:, None]
            rows[:, 5:7] = (at + length * np.arange(1, n + 1))[:, None]
            ints.frombytes(rows.tobytes())
            texts.extend(["\n"] * (step * n))
            tags.extend([tag] * n)
            attr_ends.extend([len(keys)] * n)
            open_at[tag].extend(range(depth, depth + n))
            open_nodes.frombytes(nodes.tobytes())
            open_tags.extend([tag] * n)

        def close_run(tag: str, n: int, at: int, length: int) -> int:
            """Close up to ``n`` innermost elements while they are of this tag; how many were."""
            depths = open_at[tag]
            # The innermost are of one tag as far as their depths follow one another.
            top, low = len(open_tags) - 1, 0
            high = min(n, len(depths))
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if depths[-mid] == top - mid + 1 else (low, mid - 1)
            if not low:
                return 0
            step = int(not hidden and tag in BLOCK_TAGS)
            rows = first_int + np.frombuffer(open_nodes[-low:], np.int32)[::-1].astype(np.int64) * width
            filled = np.frombuffer(ints, np.int32)
            filled[rows + 2] = len(tags) - first - 1
            filled[rows + 4] = len(texts) - first_text + step * np.arange(1, low + 1)
            filled[rows + 6] = at + length * np.arange(low)
            del filled  # the array cannot grow while it is viewed
            texts.extend(["\n"] * (step * low))
            del depths[-low:], open_nodes[-low:], open_tags[-low:]
            return low

        match, find = _TOKEN.match, html.find
        at, end = 0, len(html)
        last_close = html.rfind(">")
        while at < end:
            start, token = find("<", at), None
            while start >= 0 and not (token := match(html, start)):
                # Behind the last ">" no tag can end; only a comment may be open.
                next_open = "<" if start < last_close else "<!"
                start = find(next_open, start + 1)
            start = start if token else end
            if start > at and not hidden:
                data = html[at:start]
                texts.append(unescape(data) if "&" in data else data)
            if not token:
                break
            at = token.end()
            closing, opening, attrs = token.groups()
            if closing:
                tag = closing.lower()
                if open_tags and open_tags[-1] == tag:
                    close(len(open_tags) - 1, start)
                elif open_at.get(tag):
                    close_nearest({tag}, NO_FENCE, start)
                if html.startswith("</", at) and open_at.get(tag) and tag not in HIDDEN_TAGS:
                    again, length = html[start:at], at - start
                    if html.startswith(again * RUN, at):
                        at += length * close_run(tag, _repeats(html, again, at), at, length)
                continue
            if not opening:
                continue
            tag = opening.lower()
            if tag in CLOSES_PARAGRAPH:
                if open_at.get("p"):
                    close_nearest({"p"}, PARAGRAPH_FENCE, start)
            elif tag in CLOSES_SIBLING:
                close_nearest(*CLOSES_SIBLING[tag], start)
            if not hidden and (tag in BLOCK_TAGS or tag == "br"):
                texts.append("\n")
            node, n_texts = len(tags) - first, len(texts) - first_text
            ints.extend((node, open_nodes[-1] if open_nodes else -1, node, n_texts, n_texts, at, at))
            tags.append(tag)
            if attrs:
                own = _attributes(attrs)
                keys.extend(own)
                values.extend(own.values())
            attr_ends.append(len(keys))
            if tag in VOID_TAGS:
                continue
            if attrs.endswith("/") and (tag in FOREIGN_TAGS or nearest(FOREIGN_TAGS) >= 0):
                continue
            if tag in open_at:
                open_at[tag].append(len(open_tags))
            else:
                open_at[tag] = [len(open_tags)]
            open_nodes.append(node)
            open_tags.append(tag)
            if tag in HIDDEN_TAGS:
                hidden += 1
                if tag in RAW_TEXT_TAGS:
                    # The content is no markup: jump to the closing tag.
                    closing_tag = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
                    at = closing_tag.start() if closing_tag else end
            elif not attrs and tag not in CLOSES_SIBLING and tag != "p":
                # A tag that is repeated at once: its elements lie in one another.
                again = html[start:at]
                if html.startswith(again * RUN, at):
                    n = _repeats(html, again, at)
                    open_run(tag, n, at, len(again))
                    at += n * len(again)
        close(0, end)

    def to_arrow(self) -> pa.Array:
        def int_column(values: array) -> pa.Array:
            return pa.array(np.frombuffer(values, np.int32) if values else [], pa.int32())

        def ends(values: array) -> pa.Array:
            return int_column(array("i", [0]) + values)

        table = self._rows()
        ints = {name: pa.array(table[:, i]) for i, name in enumerate(self.INTS)}
        columns = {
            **{name: ints[name] for name in self.INTS[:3]},
            "tag": pa.array(self.tags, pa.string()),
            "attrs": pa.MapArray.from_arrays(
                ends(self.attr_ends),
                pa.array(self.keys, pa.string()),
                pa.array(self.values, pa.string()),
            ),
            **{name: ints[name] for name in self.INTS[3:]},
        }
        elements = pa.StructArray.from_arrays(list(columns.values()), list(columns))
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(ends(self.page_ends), elements),
                pa.ListArray.from_arrays(ends(self.text_ends), pa.array(self.texts, pa.string())),
            ],
            ["els", "texts"],
            mask=pa.array(self.missing, pa.bool_()),
        )


_MEMORY = Memory()


def parse_batch(html: pa.Array) -> pa.Array:
    batch = PageBatch(_MEMORY)
    for page in html.to_pylist():
        batch.add(page)
    return batch.to_arrow()


cloudpickle.register_pickle_by_value(sys.modules[__name__])

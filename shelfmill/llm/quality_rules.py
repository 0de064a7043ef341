"""Quality rules with repetition measured on suffix arrays of words.

Each text gets the suffix array of its words and the lengths of the longest
common prefixes of neighbours. The intervals of that array are the maximal
repeated substrings; the longest one that starts at a word is the larger of
the two prefixes next to its suffix. The union of these spans is the repeated
part of a text, and their longest the longest repeat. Texts are sorted many at
a time by prefix doubling; the text's number is part of the first key, so that
nothing repeats across texts.

The base rule is a floor: too few words, or over a fifth of them in repeats.
The verdict ``kept`` also limits the share covered by repeats more tightly, the
share covered by long repeats, and the longest repeat. No limit implies another:
many short repeats, some copied passages or one copied block each fail one only.

Defined cases: a null or blank text has no words and fails. A repeated row gets
its own result. Extra columns are kept by ``keep_good`` and ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.llm import bytescan as bs


@dataclass(frozen=True)
class QualityRules:
    """Limits of the rules, all in words."""

    min_words: int = 10
    base_repeat: int = 5  # repeats of this length count for the base rule
    max_base_percent: int = 20
    repeat: int = 5  # repeats of this length count for the covered share
    max_covered_percent: int = 15
    long_repeat: int = 20  # repeats of this length count for the long share
    max_long_percent: int = 5
    max_longest: int = 100  # words of the longest repeat


SYMBOLS = b"#*$%&|<>"

_FIELDS = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("covered_words", "long"), ("longest_repeat", "long"), ("base_failed", "boolean"), ("kept", "boolean")]


def longest_repeats(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each word the length of the longest run of words from it that occurs again in its text.

    ``words`` are 64-bit hashes, ``bounds`` the first word of each text and the end.
    """
    n = len(words)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    text = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
    stop = np.repeat(bounds[1:], np.diff(bounds)).astype(np.int64)

    # Rank of each suffix by its first word, texts apart: the place where its group starts.
    order = np.lexsort((words, text))
    rank = np.empty(n, np.int64)
    fresh = np.ones(n, bool)
    fresh[1:] = (words[order[1:]] != words[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, n))
    rank[order] = np.repeat(heads, sizes)

    levels = [rank.copy()]
    active = order[np.repeat(sizes, sizes) > 1]  # suffixes that share their rank, in order
    array, width = order.copy(), 1
    while len(active):
        ahead = active + width
        second = np.where(ahead < stop[active], rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = (rank[active].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        sort = np.argsort(key, kind="stable")
        active, key = active[sort], key[sort]
        base = (key >> np.uint64(32)).astype(np.int64)
        group = np.ones(len(base), bool)
        group[1:] = base[1:] != base[:-1]
        first = np.flatnonzero(group)
        place = base + np.arange(len(base)) - np.repeat(first, np.diff(np.append(first, len(base))))
        array[place] = active
        # A new group starts where the key changes; suffixes that ended stay apart from all.
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | ((key[1:] & np.uint64(0xFFFFFFFF)) == 0)
        heads = np.flatnonzero(fresh)
        sizes = np.diff(np.append(heads, len(key)))
        rank[active] = np.repeat(place[heads], sizes)
        levels.append(rank.copy())
        active = active[np.repeat(sizes, sizes) > 1]
        width *= 2

    # Longest common prefixes of neighbours in the array, by descending powers of two.
    a, b = array[:-1], array[1:]
    same = levels[0][a] == levels[0][b]
    a, b = a[same], b[same]
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        inside = (i + (1 << k) <= stop[a]) & (j + (1 << k) <= stop[b])
        i, j = np.minimum(i, n - 1), np.minimum(j, n - 1)
        common += np.where(inside & (levels[k][i] == levels[k][j]), 1 << k, 0)
    np.maximum.at(longest, a, common)
    np.maximum.at(longest, b, common)
    return longest


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[bounds])


def _measure(data: np.ndarray, offsets: np.ndarray, rules: QualityRules) -> dict[str, np.ndarray]:
    starts, ends = bs.spaced_words(data, offsets)
    bounds = bs.per_text(starts, offsets)
    hashes = bs.byte_hash(data)
    n_words = np.diff(bounds)
    inside = bs.covered(starts, ends - starts, len(data)) if len(starts) else np.zeros(len(data), bool)
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True

    # Lines: the text's parts between line feeds; those with a word that came before in the text.
    feeds = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], feeds + 1]))
    owner = np.searchsorted(offsets[1:], line_starts, "right")
    feed_at = np.append(feeds, len(data))
    owner = np.minimum(owner, len(offsets) - 2)
    line_ends = np.minimum(feed_at[np.searchsorted(feeds, line_starts)], offsets[owner + 1])
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, owner = line_starts[filled], line_ends[filled], owner[filled]
    keys = hashes(line_starts, line_ends) + bs.mix(owner.astype(np.uint64))
    _, earliest = np.unique(keys, return_index=True)
    n_dup_lines = np.bincount(owner, minlength=len(n_words)) - np.bincount(owner[earliest], minlength=len(n_words))

    longest = longest_repeats(hashes(starts, ends), bounds)

    def repeated(least: int) -> np.ndarray:
        at = np.flatnonzero(longest >= least)
        return _sums(bs.covered(at, longest[at], len(longest)), bounds)

    n_repeat, n_covered = repeated(rules.base_repeat), repeated(rules.repeat)
    top = np.zeros(len(n_words), np.int64)
    np.maximum.at(top, np.repeat(np.arange(len(n_words)), n_words), longest)
    top[top < rules.repeat] = 0
    failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_base_percent * n_words)
    good = (100 * n_covered <= rules.max_covered_percent * n_words) & (100 * repeated(rules.long_repeat) <= rules.max_long_percent * n_words) & (top <= rules.max_longest)
    return {
        "n_words": n_words,
        "word_chars": _sums(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _sums(is_symbol[data], offsets),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "covered_words": n_covered,
        "longest_repeat": top,
        "base_failed": failed,
        "kept": ~failed & good,
    }


def quality(text: Column | str, rules: QualityRules = QualityRules()) -> Column:
    """Struct of the measures of a text and the verdict ``kept``.

    ``longest_repeat`` counts repeats of at least ``rules.repeat`` words.
    """
    kind = pa.struct([(name, pa.int64() if t == "long" else pa.bool_()) for name, t in _FIELDS])

    @F.arrow_udf("struct<" + ",".join(f"{name}:{t}" for name, t in _FIELDS) + ">")
    def measure(texts: pa.Array) -> pa.Array:
        parts = [_measure(data, offsets, rules) for _, _, data, offsets in bs.blocks(texts)]
        arrays = [pa.array(np.concatenate([p[f.name] for p in parts]) if parts else [], f.type) for f in kind]
        return pa.StructArray.from_arrays(arrays, fields=list(kind))

    return measure(text)


def keep_good(documents: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Rows of ``documents`` whose text the rules keep; all columns stay."""
    return documents.where(quality(documents["text"], rules)["kept"])

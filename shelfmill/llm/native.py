"""Helpers for expressions of built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_GROUP = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(items: Column, size: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0), lambda total, x: total + size(x))


def with_place(items: Column, size: Callable[[Column], Column], made: Callable[[Column, Column], Column]) -> Column:
    """``made(item, total size of the items before it)`` for each item of an array.

    Sizes are summed in groups, so that the work grows little more than
    linearly with the items.
    """

    def grouped(items: Column) -> Column:
        groups = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _GROUP).cast("int"))
        totals = F.transform(groups, lambda g: _total(F.slice(items, g * _GROUP + 1, F.lit(_GROUP)), size))

        def placed(heads: Column) -> Column:
            def one(item: Column, i: Column) -> Column:
                rest = i % _GROUP
                return made(item, F.get(heads, F.floor(i / _GROUP).cast("int")) + _total(F.slice(items, i - rest + 1, rest), size))

            return F.transform(items, one)

        heads = let(totals, lambda t: F.transform(t, lambda _, g: _total(F.slice(t, F.lit(1), g), lambda x: x)))
        return let(heads, placed)

    return let(items, lambda kept: F.when(F.size(kept) > 0, grouped(kept)))


def largest_before(values: Column) -> Column:
    """For each item of an array of ints the largest of the items before it, 0 for the first.

    As in ``with_place``, groups keep the work near linear.
    """

    def grouped(values: Column) -> Column:
        groups = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _GROUP).cast("int"))
        tops = F.transform(groups, lambda g: F.array_max(F.slice(values, g * _GROUP + 1, F.lit(_GROUP))))

        def placed(heads: Column) -> Column:
            def one(_: Column, i: Column) -> Column:
                rest = i % _GROUP
                own = F.array_max(F.slice(values, i - rest + 1, rest))
                return F.greatest(F.lit(0), F.get(heads, F.floor(i / _GROUP).cast("int")), own)

            return F.transform(values, one)

        heads = let(tops, lambda t: F.transform(t, lambda _, g: F.array_max(F.slice(t, F.lit(1), g))))
        return let(heads, placed)

    return let(values, lambda kept: F.when(F.size(kept) > 0, grouped(kept)))


_PIECE = 1024


def cutter(text: Column, body: Callable[[Callable[[Column, Column], Column]], Column]) -> Column:
    """``body(cut)``, where ``cut(start, size)`` is a part of the text by code points from 0.

    A substring counts code points from the text's start; here it counts from
    a piece of the text near by, so that many parts of a long text stay cheap.
    """

    def of(pieces: Column) -> Column:
        def cut(start: Column, size: Column) -> Column:
            first = F.floor(start / _PIECE).cast("int")
            count = F.floor((start + size) / _PIECE).cast("int") - first + 1
            return F.substring(F.array_join(F.slice(pieces, first + 1, count), ""), start % _PIECE + 1, size)

        return body(cut)

    return let(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_PIECE}}}"), F.lit(0)), of)

r"""Chat formatting with a grammar that can be read back, in built-in functions only.

A conversation is rendered as ``<turn ROLE>\nTEXT\n</turn>\n`` for each turn.
It is then parsed again and the recovered turns are compared with the source.
The grammar allows no ``<turn`` or ``</turn`` inside a text unless a backslash
precedes it, and the parser takes one such backslash away. A conversation that
does not come back as it was is rendered again with one backslash more before
every such string; what then comes back is the source, which ``exact`` states.
In a role, line feeds, ``<`` and ``%`` are written as ``%0A``, ``%3C``, ``%25``.

The loss mask covers the texts of the trained role, as they stand in the
rendered conversation, without markers.

Defined cases: null texts and roles are empty. Turns go by number, null first,
ties by role, then text; repeated rows are repeated turns. Rows without a
conv_id form one conversation. Extra columns are ignored. A conversation is one
row of the result, so its turns meet in one task, and nowhere more than that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.llm.native import let, with_place

_OPEN, _CLOSE = "<turn ", "</turn>\n"
_CONTROL = "</?turn"
_RUN = r"(?<!\\)\\*+"  # backslashes from the first of a run, so that each run is read once


@dataclass(frozen=True)
class ChatTemplate:
    trained_role: str = "assistant"


def _escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({_RUN}{_CONTROL})", r"\\$1")


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)\\(\\*+{_CONTROL})", "$1")


def _role_out(role: Column) -> Column:
    for plain, written in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(plain), F.lit(written))
    return role


def _role_in(role: Column) -> Column:
    for plain, written in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(written), F.lit(plain))
    return role


def render(turns: Column, escaped: bool) -> Column:
    """Text of an array of ``role, text``."""

    def one(turn: Column) -> Column:
        text = _escape(turn.text) if escaped else turn.text
        return F.concat(F.lit(_OPEN), _role_out(turn.role), F.lit(">\n"), text, F.lit("\n" + _CLOSE))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """Array of ``role, text, start, stop`` of a rendered conversation.

    ``start`` and ``stop`` are where the written text stands, in code points.
    A text that breaks the grammar comes back as null.
    """
    # A written text is followed by a line feed, so no backslash of its own touches the end marker.
    parts = F.split(formatted, rf"(?<!\\){_CLOSE}", -1)

    def read(part: Column, before: Column) -> Column:
        def body(role: Column) -> Column:
            head = F.length(role) + len(_OPEN) + 2
            size = F.length(part) - head - 1
            written = F.substring(part, head + 1, size)
            text = F.when(~written.rlike(rf"(?<!\\){_CONTROL}"), _unescape(written))
            return F.struct(_role_in(role).alias("role"), text.alias("text"), (before + head).alias("start"), (before + head + size).alias("stop"))

        return let(F.regexp_extract(part, rf"^{_OPEN}([^\n]*)>\n", 1), body)

    def placed(parts: Column) -> Column:
        turns = F.slice(parts, F.lit(1), F.size(parts) - 1)  # after the last end marker nothing is left
        return F.when(F.size(parts) > 1, with_place(turns, lambda p: F.length(p) + len(_CLOSE), read))

    return let(parts, placed)


def format_chats(conversations: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """``conv_id, formatted, turns, loss_spans, exact``, a row per conversation.

    ``turns`` are ``role, text`` as read back, ``loss_spans`` the places under
    the loss mask. ``exact`` tells that the turns read back are the source's.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    turns = F.transform("rows", lambda r: F.struct(r.role.alias("role"), r.text.alias("text")))

    def read_back(parsed: Column) -> Column:
        return F.transform(parsed, lambda t: F.struct(t.role.alias("role"), t.text.alias("text")))

    def best(turns: Column) -> Column:
        """Plain rendering if it comes back, else the escaped one."""

        def chosen(plain: Column) -> Column:
            same = read_back(parse(plain)).eqNullSafe(turns)
            return F.when(same, plain).otherwise(render(turns, True))

        return let(render(turns, False), chosen)

    def result(turns: Column) -> Column:
        return let(
            best(turns),
            lambda formatted: let(
                parse(formatted),
                lambda parsed: F.struct(formatted.alias("formatted"), parsed.alias("parsed"), read_back(parsed).eqNullSafe(turns).alias("exact")),
            ),
        )

    made = grouped.select("conv_id", let(turns, result).alias("r"))
    spans = F.transform(F.filter("r.parsed", lambda t: t.role == template.trained_role), lambda t: F.struct(t.start.alias("start"), t.stop.alias("stop")))
    return made.select("conv_id", F.col("r.formatted").alias("formatted"), read_back(F.col("r.parsed")).alias("turns"), spans.alias("loss_spans"), F.col("r.exact").alias("exact"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """Source text under the loss mask, from the rendered conversation."""
    return F.array_join(F.transform(spans, lambda s: _unescape(F.substring(formatted, s.start + 1, s.stop - s.start))), "")

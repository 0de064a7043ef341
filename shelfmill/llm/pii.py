"""Personal data in texts: patterns, checksums and context, in built-in functions only.

Regular expressions propose spans. A span must pass its kind's check: parts of
an address, Luhn's digit for cards, the remainder by 97 for account numbers,
a count of digits. Each kind has a score; context words in the characters
before a span raise it. Spans of the basic kinds always stay; other kinds need
``min_score``.

Matches are taken from the left without overlap in each kind; one that fails
its check is dropped and its characters are not tried again. Patterns begin
where no longer match could have begun, and never give back what they took, so
a scan is linear in the text, also in long runs without a match. Places are
code points.

Defined cases: a null text is empty; repeated rows are repeated; extra columns
stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmill.llm.native import cutter, largest_before, let, with_place

CONTEXT_CHARS = 32


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    check: Callable[[Column], Column]
    score: float
    basic: bool = True
    context: tuple[str, ...] = ()
    raised: float = 0.4
    needs: str = ""  # a character that any match has; texts without it are not scanned


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _address_ok(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))


def _card_ok(value: Column) -> Column:
    return let(_digits(value), lambda d: F.length(d).between(12, 19) & F.call_function("luhn_check", d))


def _phone_ok(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def _account_ok(value: Column) -> Column:
    """ISO 7064 remainder of an account number with its first four characters moved to the end."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    remainder = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda r, c: F.when(c.between("0", "9"), (r * 10 + F.ascii(c) - 48) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97),
    )
    return F.length(plain).between(15, 34) & (remainder == 1)


def _any(value: Column) -> Column:
    return F.lit(True)


# A match may begin after a character of its own class only where the match before it ended.
_RUN = r"(?:(?<![{0}])|\G)[{0}]++"

BASIC_KINDS = (
    Kind("email", _RUN.format("A-Za-z0-9._%+-") + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _any, 0.9, context=("mail", "contact", "write to"), needs="@"),
    Kind("ip", _RUN.format("0-9") + r"\.[0-9]++\.[0-9]++\.[0-9]++", _address_ok, 0.6, context=("ip", "address", "host", "from")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card_ok, 0.9, context=("card", "visa", "credit", "payment")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone_ok, 0.6, context=("phone", "tel", "call", "mobile"), needs="+"),
)
ADDED_KINDS = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{1,4}){3,8}(?![A-Za-z0-9])", _account_ok, 0.9, basic=False, context=("iban", "account", "bank")),
    Kind("secret", r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,128}(?![A-Za-z0-9])", _any, 0.3, basic=False, context=("token", "secret", "key", "password")),
)


@dataclass(frozen=True)
class PiiRules:
    kinds: tuple[Kind, ...] = field(default=BASIC_KINDS + ADDED_KINDS)
    min_score: float = 0.6


_SPAN = "struct<start:int,rank:int,stop:int,kind:string,score:double,basic:boolean>"


def _proposed(text: Column, kind: Kind, rank: int, rules: PiiRules) -> Column:
    """Spans of one kind that pass, in order."""

    def placed(found: Column) -> Column:
        # The text between matches and the matches alternate.
        gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found))
        steps = F.zip_with(found, gaps, lambda value, gap: F.struct(value.alias("value"), F.length(gap).alias("gap"), F.length(value).alias("size"), F.right(gap, F.lit(CONTEXT_CHARS)).alias("before")))

        def span(x: Column, before: Column) -> Column:
            start = before + x.gap
            near = F.lower(x.before).rlike(r"\b(?:" + "|".join(kind.context) + r")") if kind.context else F.lit(False)
            score = F.when(near, F.least(F.lit(1.0), F.lit(kind.score + kind.raised))).otherwise(F.lit(kind.score))
            return F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x.size).alias("stop"), F.lit(kind.name).alias("kind"), score.alias("score"), F.lit(kind.basic).alias("basic"), x.value.alias("value"))

        spans = with_place(steps, lambda x: x.gap + x.size, span)
        passed = F.filter(spans, lambda s: kind.check(s.value) & (s.basic | (s.score >= rules.min_score)))
        return F.transform(passed, lambda s: F.struct(s.start.alias("start"), s.rank.alias("rank"), s.stop.alias("stop"), s.kind.alias("kind"), s.score.alias("score"), s.basic.alias("basic")))

    none = F.array().cast(f"array<{_SPAN}>")
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    spans = let(found, lambda f: F.when(F.size(f) > 0, placed(f)).otherwise(none))
    return F.when(F.contains(text, F.lit(kind.needs)), spans).otherwise(none) if kind.needs else spans


def spans(text: Column | str, rules: PiiRules = PiiRules()) -> Column:
    """Array of ``start, rank, stop, kind, score, basic`` of a text, by start, then kind as listed."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.array_sort(F.concat(*[_proposed(text, kind, rank, rules) for rank, kind in enumerate(rules.kinds)]))


def listed(found: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with each run of overlapping spans replaced by its first kind in brackets."""

    def rebuilt(found: Column) -> Column:
        ends = F.transform(found, lambda s: s.stop)

        def merged(reaches: Column) -> Column:
            # A span opens a run if none before it reaches beyond its start.
            placed = F.zip_with(found, reaches, lambda s, r: F.struct(s.start.alias("start"), s.kind.alias("kind"), r.alias("reach")))
            opens = F.filter(placed, lambda s: s.reach <= s.start)

            def joined(cut: Callable[[Column, Column], Column]) -> Column:
                def piece(s: Column) -> Column:
                    return F.concat(cut(s.reach, s.start - s.reach), F.lit("["), F.upper(s.kind), F.lit("]"))

                return F.array_join(F.transform(opens, piece), "")

            return F.concat(cutter(text, joined), F.substring(text, F.array_max(ends) + 1, F.length(text)))

        return let(largest_before(ends), merged)

    return let(found, lambda f: F.when(F.size(f) > 0, rebuilt(f)).otherwise(text))


def find_pii(documents: DataFrame, rules: PiiRules = PiiRules(), name: str = "pii") -> DataFrame:
    """``documents`` with the spans of each text as column ``name``."""
    return documents.withColumn(name, spans(documents["text"], rules))


def redact(documents: DataFrame, rules: PiiRules = PiiRules()) -> DataFrame:
    """``documents`` with personal data replaced in ``text``; a null text stays null."""
    text = documents["text"]
    clean = F.when(text.isNotNull(), redacted(text, spans(text, rules)))
    return documents.withColumn("text", clean)

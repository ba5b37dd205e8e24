"""Personal data: patterns propose spans, checksums confirm them, context adjusts scores.

Column expressions only. Every pattern takes its longest match possessively or over
disjoint classes, and starts only where a run starts, so that long runs of digits or
letters cost neither stack nor quadratic time.

A null text has no spans and an empty list; so has an empty one. Rows that repeat are
each searched. Other columns pass through; the result column replaces one of its name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string,score:double>>"
NEAR = 48


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _has_digits(match: Column, least: int, most: int) -> Column:
    return F.length(_digits(match)).between(least, most)


def octets(match: Column) -> Column:
    """All four numbers are at most 255, however many zeros lead them."""
    parts = F.split(match, "[.]")
    return F.forall(parts, lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))


def luhn(match: Column) -> Column:
    """12 to 19 digits whose sum, every second from the right doubled, ends in 0."""
    figures = F.filter(F.split(F.reverse(_digits(match)), ""), lambda c: c != "")
    doubled = F.transform(
        figures,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return F.when(_has_digits(match, 12, 19), total % 10 == 0).otherwise(False)


def mod97(match: Column) -> Column:
    """An account number with its first four characters moved to the end leaves 1."""
    bare = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substr(bare, F.lit(5)), F.substring(bare, 1, 4))
    figures = F.filter(F.split(moved, ""), lambda c: c != "")

    def step(rest: Column, c: Column) -> Column:
        letter = c >= "A"
        value = F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return ((rest * F.when(letter, 100).otherwise(10) + value) % 97).cast("int")

    return F.aggregate(figures, F.lit(0), step) == 1


@dataclass(frozen=True)
class Kind:
    """A pattern, what a text must hold for it to be tried, the check of its matches,
    the score of a match that passes, and words that raise the score when near."""

    name: str
    pattern: str
    gate: Callable[[Column], Column]
    check: Callable[[Column], Column]
    score: float
    words: str


def _digit_in(text: Column) -> Column:
    return text.rlike("[0-9]")


KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: t.contains("@"),
        lambda m: F.lit(True),
        0.8,
        "mail|contact|write",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _digit_in,
        octets,
        0.6,
        r"\bip\b|address|host|server",
    ),
    Kind(
        "card",
        r"[0-9](?:[ -]?+[0-9])++",
        _digit_in,
        luhn,
        0.7,
        "card|visa|master|credit|payment",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda t: t.contains("+"),
        lambda m: _has_digits(m, 9, 15),
        0.6,
        "phone|tel|call|mobile|fax",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
        _digit_in,
        mod97,
        0.9,
        "iban|bank|account|konto|cuenta|compte",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        _digit_in,
        lambda m: F.lit(True),
        0.3,
        r"\bssn\b|social security",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+().-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
        _digit_in,
        lambda m: F.lit(True),
        0.3,
        "phone|tel|call|mobile|fax",
    ),
)


def _matches(text: Column, kind: Kind) -> Column:
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return F.when(kind.gate(text), found)


def _spans(matches: Column, between: Column, kind: Kind) -> Column:
    """Matches with their places: the lengths of what stands before them, added up."""

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["found"])
        span = F.struct(
            start.alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            end.alias("end"),
            F.lit(kind.name).alias("kind"),
            x["found"].alias("value"),
            F.lit(kind.score).alias("score"),
        )
        kept = F.when(kind.check(x["found"]), F.array_append(acc["out"], span))
        return F.struct(end.alias("at"), kept.otherwise(acc["out"]).alias("out"))

    pairs = F.arrays_zip(
        F.slice(between, F.lit(1), F.size(matches)).alias("gap"), matches.alias("found")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def _in_context(text: Column, span: Column) -> Column:
    """The span with a higher score where a word of its kind stands shortly before."""
    size = F.least(span["start"], F.lit(NEAR))
    before = F.lower(F.substr(text, span["start"] - size + 1, size))
    near = F.lit(False)
    for i, kind in enumerate(KINDS):
        near = F.when(span["rank"] == i, before.rlike(kind.words)).otherwise(near)
    raised = F.least(F.lit(1.0), span["score"] + F.when(near, 0.3).otherwise(0.0))
    return F.struct(
        *(span[f].alias(f) for f in ("start", "rank", "end", "kind", "value")), raised.alias("score")
    )


def find_personal_data(
    docs: DataFrame, text: str = "text", out: str = "personal_data", threshold: float = 0.5
) -> DataFrame:
    """Adds the spans of every text, in code points, by start, then by kind.

    Each has start, rank (of its kind), end, kind, value and score. Spans of the base
    kinds that pass their check all score above any threshold up to 0.6; others stay
    when their score, with that of words nearby, reaches it.
    """
    if threshold > 0.6:
        raise ValueError("a threshold above 0.6 would drop confirmed spans")
    columns = [c for c in docs.columns if c != out]
    body = F.col(f"`{text}`")
    # A name that begins no column of the documents.
    made = out
    while any(c.lower().startswith(f"{made}_".lower()) for c in columns):
        made += "_"
    staged = docs.select(
        *(F.col(f"`{c}`") for c in columns),
        *(_matches(body, k).alias(f"{made}_m{i}") for i, k in enumerate(KINDS)),
    )
    staged = staged.select(
        "*",
        *(
            F.when(F.size(f"{made}_m{i}") > 0, F.split(body, k.pattern, -1)).alias(f"{made}_p{i}")
            for i, k in enumerate(KINDS)
        ),
    )
    lists = [
        F.when(
            F.size(f"{made}_m{i}") > 0, _spans(F.col(f"{made}_m{i}"), F.col(f"{made}_p{i}"), k)
        ).otherwise(F.array().cast(SPAN))
        for i, k in enumerate(KINDS)
    ]
    staged = staged.select(*(F.col(f"`{c}`") for c in columns), F.concat(*lists).alias(out))
    scored = F.filter(
        F.transform(out, lambda s: _in_context(body, s)), lambda s: s["score"] >= threshold
    )
    spans = F.when(F.size(out) > 0, F.array_sort(scored)).otherwise(F.col(out))
    return staged.select(*(F.col(f"`{c}`") for c in columns), spans.alias(out))

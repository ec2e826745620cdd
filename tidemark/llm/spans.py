"""Spans of pattern matches in a text column, by SQL functions alone.

A pattern's matches are fenced with a character that the text does not hold, and the text is split
there, so every second part is a match; running sums of the parts' lengths give its place in code
points. A span is (start, kind, end, its text, some text before it), so spans sort by start, then
kind. Texts with very many matches take time in proportion to them, or nearly so.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = "\u0001"
SPANS = "array<struct<start:int,kind:int,end:int,found:string,before:string>>"
CONTEXT = 24
# Elements of an array that are worked on together.
BLOCK = 128


def fenceless(text: Column) -> Column:
    """The text, empty for null, with fences replaced by another control character."""
    return F.translate(F.coalesce(text, F.lit("")), FENCE, "\u0002")


def parts(text: Column, pattern: str) -> Column:
    return F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{FENCE}$0{FENCE}")), FENCE, -1)


def bound(body: Callable[[Column], Column], **values: Column) -> Column:
    """The body's value, where its argument holds these values, each of which is found once: what a
    lambda names directly is found anew for every element."""
    held = F.array(F.struct(*(value.alias(name) for name, value in values.items())))
    return F.get(F.transform(held, body), F.lit(0))


def _blocks(values: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` elements."""
    last = F.greatest(F.ceil(F.size(values) / BLOCK).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * BLOCK + 1, F.lit(BLOCK)))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each number, the combination of 0 and all numbers before it. Appending to an array copies
    it, so blocks are worked on apart and carry on from each other: the time is in proportion to
    the numbers while these are below some millions."""
    zero = F.struct(F.lit(0).alias("acc"), F.array().cast("array<int>").alias("out"))

    def step(a: Column, x: Column, value: Column) -> Column:
        return F.struct(combine(a["acc"], value).alias("acc"), F.concat(a["out"], F.array(a["acc"])).alias("out"))

    def carried(h: Column) -> Column:
        totals = F.transform(h["blocks"], lambda one: F.aggregate(one, F.lit(0), combine))
        carries = F.aggregate(totals, zero, lambda a, x: step(a, x, x), lambda a: a["out"])

        def within(one: Column, carry: Column) -> Column:
            start = F.struct(carry.alias("acc"), F.array().cast("array<int>").alias("out"))
            return F.aggregate(one, start, lambda a, x: step(a, x, x), lambda a: a["out"])

        return F.flatten(F.zip_with(h["blocks"], carries, within))

    return bound(carried, blocks=bound(lambda h: _blocks(h["v"]), v=values))


def spans(split: Column, kind: int, holds: Callable[[Column], Column] | None = None) -> Column:
    """Spans of the matches among these parts that ``holds`` accepts."""

    def located(h: Column) -> Column:
        part = lambda i: F.get(h["parts"], i)
        matches = F.sequence(F.lit(1), F.size(h["parts"]) - 1, F.lit(2))
        if holds is not None:
            matches = F.filter(matches, lambda i: holds(part(i)))
        return F.transform(
            matches,
            lambda i: F.struct(
                F.get(h["starts"], i).alias("start"),
                F.lit(kind).alias("kind"),
                (F.get(h["starts"], i) + F.char_length(part(i))).alias("end"),
                part(i).alias("found"),
                F.right(part(i - 1), F.lit(CONTEXT)).alias("before"),
            ),
        )

    starts = running(F.transform(split, F.char_length), lambda a, x: a + x)
    return F.when(F.size(split) > 1, bound(located, parts=split, starts=starts)).otherwise(F.array().cast(SPANS))


def marked(found: Column, others: Column) -> Column:
    """The spans as ``span``, and whether each one ``meets`` any of the others. Blocks of those are
    held against a span by their outer ends first."""

    def ends(one: Column) -> Column:
        low, high = F.array_min(F.transform(one, lambda o: o["start"])), F.array_max(F.transform(one, lambda o: o["end"]))
        return F.struct(low.alias("low"), high.alias("high"), one.alias("spans"))

    def meets(h: Column, s: Column) -> Column:
        inside = lambda k: F.exists(k["spans"], lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))
        return F.exists(h["blocks"], lambda k: (k["low"] < s["end"]) & (s["start"] < k["high"]) & inside(k))

    def told_apart(h: Column) -> Column:
        return F.transform(h["found"], lambda s: F.struct(s.alias("span"), F.coalesce(meets(h, s), F.lit(False)).alias("meets")))

    blocks = bound(lambda h: F.transform(_blocks(h["v"]), ends), v=others)
    return bound(told_apart, found=found, blocks=blocks)


def apart(found: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.transform(F.filter(marked(found, others), lambda m: ~m["meets"]), lambda m: m["span"])


def told(found: Column, names: tuple[str, ...]) -> Column:
    """``kind:start:end`` of each span, joined by commas, in the given order."""
    kinds = F.array(*map(F.lit, names))
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redacted(text: Column, found: Column, sign: str) -> Column:
    """The text with each run of overlapping spans replaced by the sign.

    Reaching a place in a text takes time in proportion to the place, so the text is cut into pieces first,
    one for each block of spans."""

    def gaps(h: Column) -> Column:
        """What stands before each run of spans."""
        at, start = lambda i: F.get(h["before"], i), lambda i: F.get(h["spans"], i)["start"]
        heads = F.filter(F.sequence(F.lit(0), F.size(h["spans"]) - 1), lambda i: start(i) >= at(i))

        def cut(block: Column) -> Column:
            def pieces(b: Column) -> Column:
                return F.transform(b["heads"], lambda i: F.substring(b["piece"], at(i) - b["from"] + 1, start(i) - at(i)))

            first = at(F.get(block, F.lit(0)))
            piece = F.substring(text, first + 1, start(F.element_at(block, -1)) - first)
            return bound(pieces, heads=block, piece=piece, **{"from": first})

        return F.flatten(F.transform(bound(lambda b: _blocks(b["heads"]), heads=heads), cut))

    def whole(h: Column) -> Column:
        last = F.array_max(F.transform(h["spans"], lambda s: s["end"]))
        return F.array_join(F.concat(gaps(h), F.array(F.substring(text, last + 1, F.char_length(text)))), sign)

    ends = running(F.transform(F.array_sort(found), lambda s: s["end"]), lambda a, x: F.greatest(a, x))
    return F.when(F.size(found) > 0, bound(whole, spans=F.array_sort(found), before=ends)).otherwise(text)

"""Token labels to spans, and spans to redacted text, as row-local column expressions.

Offsets are code points, ends exclusive. Nothing here shuffles or leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainmill.functions.text import SPACE
from grainmill.schemas import SPAN

_RAW = "array<struct<label:string,start:int,end:int>>"


def _raw(label: Column, start: Column, end: Column) -> Column:
    return F.struct(label.alias("label"), start.cast("int").alias("start"), end.cast("int").alias("end"))


def prefix_and_label(raw: Column) -> tuple[Column, Column]:
    """Parts of a label around its first dash; without a dash both are the label."""
    parts = F.split(raw, "-", 2)
    return parts[0], F.when(F.size(parts) > 1, parts[1]).otherwise(raw)


def raw_spans(tokens: Column) -> Column:
    """Spans of BIOES-labelled tokens, untrimmed, in the order they are completed.

    A continuation without its beginning begins a span, and an end without one is a single.
    Tokens of no length, outside tokens and unknown prefixes end what is open.
    """
    empty = F.array().cast(_RAW)
    none = _raw(F.lit(None).cast("string"), F.lit(None), F.lit(None))
    zero = F.struct(empty.alias("done"), none.alias("open"))

    def flushed(acc: Column) -> Column:
        return F.when(acc["open"]["label"].isNotNull(), F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])

    def step(acc: Column, t: Column) -> Column:
        prefix, label = prefix_and_label(t["label"])
        own = _raw(label, t["start"], t["end"])
        grown = _raw(acc["open"]["label"], acc["open"]["start"], t["end"])
        outside = t["label"].isNull() | (t["label"] == "O") | (t["end"] <= t["start"])
        same = acc["open"]["label"].isNotNull() & (acc["open"]["label"] == label)
        state = lambda done, open_: F.struct(done.alias("done"), open_.alias("open"))
        return (
            F.when(outside, state(flushed(acc), none))
            .when(prefix == "S", state(F.concat(flushed(acc), F.array(own)), none))
            .when(prefix == "B", state(flushed(acc), own))
            .when((prefix == "I") & same, state(acc["done"], grown))
            .when(prefix == "I", state(flushed(acc), own))
            .when((prefix == "E") & same, state(F.concat(acc["done"], F.array(grown)), none))
            .when(prefix == "E", state(F.concat(flushed(acc), F.array(own)), none))
            .otherwise(state(flushed(acc), none))
        )

    return F.aggregate(tokens, zero, step, flushed)


def placeholder(label: Column) -> Column:
    return F.concat(F.lit("<"), F.upper(label), F.lit(">"))


def trimmed(text: Column, span: Column) -> Column:
    """A full span without white space at its ends; it may become empty."""
    inside = F.substring(text, span["start"] + 1, span["end"] - span["start"])
    left = F.length(F.regexp_replace(inside, f"^{SPACE}+", ""))
    whole = F.length(inside)
    right = whole - F.length(F.regexp_replace(inside, f"{SPACE}+$", ""))
    start = span["start"] + (whole - left)
    end = F.greatest(start, span["end"] - right)
    body = F.substring(text, start + 1, end - start)
    return F.struct(span["label"].alias("label"), start.cast("int").alias("start"), end.cast("int").alias("end"), body.alias("text"), placeholder(span["label"]).alias("placeholder")).cast(SPAN)


def non_overlapping(spans: Column) -> Column:
    """Spans by start, the longer first; one that starts before the last one's end, or is empty, goes."""
    keyed = F.transform(spans, lambda s, i: F.struct(s["start"].alias("a"), (s["start"] - s["end"]).alias("b"), i.alias("i"), s.alias("s")))
    zero = F.struct(F.array().cast(f"array<{SPAN.simpleString()}>").alias("kept"), F.lit(0).alias("cursor"))

    def step(acc: Column, k: Column) -> Column:
        s = k["s"]
        skip = (s["start"] < acc["cursor"]) | (s["end"] <= s["start"])
        return F.when(skip, acc).otherwise(F.struct(F.concat(acc["kept"], F.array(s)).alias("kept"), s["end"].alias("cursor")))

    return F.aggregate(F.array_sort(keyed), zero, step, lambda acc: acc["kept"])


def bioes_spans(text: Column, tokens: Column) -> Column:
    """The chosen spans of a text with labelled tokens."""
    return non_overlapping(F.transform(raw_spans(tokens), lambda s: trimmed(text, s)))


def apply_redactions(text: Column, spans: Column) -> Column:
    """The text with each chosen span replaced by its placeholder. Pieces are cut between neighbours and joined once."""

    def joined(kept: Column) -> Column:
        before = lambda i: F.coalesce(F.get(kept, i - 1)["end"], F.lit(0))
        pieces = F.transform(kept, lambda s, i: F.concat(F.substring(text, before(i) + 1, s["start"] - before(i)), s["placeholder"]))
        rest = F.substring(text, before(F.size(kept)) + 1, F.length(text))
        return F.concat(F.array_join(pieces, ""), rest)

    return F.transform(F.array(non_overlapping(spans)), joined)[0]  # the chosen spans are worked out once


def label_set(spans: Column) -> Column:
    """Distinct labels, in capitals, in order."""
    return F.array_sort(F.array_distinct(F.transform(spans, lambda s: F.upper(s["label"]))))


def truncated(tokens: Column, max_tokens: int) -> Column:
    """The tokens that are classified; what is behind them stays as it is."""
    return F.slice(tokens, 1, max_tokens)


def argmax(values: Column) -> Column:
    """Zero-based place of the first largest value."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")

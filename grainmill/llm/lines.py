"""Native expressions over words and lines, shared by the line operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space of words and of the ends of lines.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A to Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def key_hash(key: Column) -> Column:
    """128 bits of a key, so that chance equality stays negligible over 10^12 lines."""
    return F.struct(F.xxhash64(key).alias("k1"), F.xxhash64(F.lit("second"), key).alias("k2"))


def with_row_hash(df: DataFrame, *cols: str) -> DataFrame:
    """Adds ``r1, r2``, 128 bits of the named columns. Rows alike in them share it and get the same result."""
    return df.withColumns({"r1": F.xxhash64(*cols), "r2": F.xxhash64(F.lit("second"), *cols)})


def without_places(text: Column, places: Column) -> Column:
    """A text without the lines of those numbers."""
    return bind(F.split(text, "\n"), lambda lines: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places), lambda i: F.get(lines, i)), "\n"))

"""Redaction and the gate over streams. Stateless, so append mode and any source will do.

An extension of this library: cross-batch dedup keeps a bounded state by a watermark;
groups and split priority are not incremental and stay batch-only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.text import digest, normalized
from grainmill.operators.redact import gate, redacted


def redact_stream(stream: DataFrame, tokens: Callable[[Column], Column], text_col: str = "text") -> DataFrame:
    """Redacted rows with the gate's verdict."""
    return gate(redacted(stream, tokens(F.col(text_col)), text_col)).drop("spans")


def without_repeats(stream: DataFrame, time_col: str, delay: str, text_col: str = "text") -> DataFrame:
    """Rows whose normalised text didn't come within the watermark's delay before."""
    keyed = stream.withWatermark(time_col, delay).withColumn("document_sha256", digest(normalized(F.col(text_col))))
    return keyed.dropDuplicatesWithinWatermark(["document_sha256"])

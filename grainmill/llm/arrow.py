"""Running a Python function over whole texts in Arrow batches of bounded size.

A worker holds one batch from Spark, one slice of it with what the function makes of that,
and a batch on its way back. Batches are bounded in bytes by a setting of the session that
:func:`bound_batches` lowers, slices by :func:`slices`; only a single longer text exceeds
them. What a slice took goes back to the system before the next one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A slice handed to the function ends at whichever bound comes first (one text may exceed the bytes).
SLICE_ROWS, SLICE_BYTES = 8192, 4 << 20
#: Bytes after which Spark ends a batch for a Python function.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Lowers the session's bound on the bytes of a batch. It must hold when a result is written, so it stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if now <= 0 or now > most:
        spark.conf.set(key, f"{most}b")


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return None


def release() -> None:
    """Gives memory that nothing holds any more back to the system, so that idle workers are small."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def slices(batch: pa.RecordBatch, sized: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of bounded rows and bytes of its column number ``sized``."""
    column = batch.column(sized)
    start = taken = 0
    lengths = pc.binary_length(column).fill_null(0).to_pylist()
    for i, n in enumerate(lengths):
        if i > start and (i - start >= SLICE_ROWS or taken + n > SLICE_BYTES):
            yield batch.slice(start, i - start)
            start, taken = i, 0
        taken += n
    if start < len(lengths):
        yield batch.slice(start)


def map_texts(
    df: DataFrame,
    keep: Sequence[str],
    text: str,
    fn: Callable[[pa.Array], dict],
    fields: Sequence[T.StructField],
) -> DataFrame:
    """``keep`` columns plus what ``fn`` makes of the text column, a row for each row.

    ``fn`` takes an Arrow array of texts and returns a sequence of equal length for each
    new field's name. The text leaves the Python worker again
    only if it is in ``keep``.
    """
    own = [f for f in df.schema.fields if f.name in keep]
    own.sort(key=lambda f: list(keep).index(f.name))
    schema = T.StructType([*own, *fields])
    arrow = to_arrow_schema(schema)
    n = len(own)
    names = [f.name for f in own]
    at = names.index(text) if text in names else n

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                made = fn(part.column(at))
                new = [pa.array(made[f.name], arrow.field(f.name).type) for f in fields]
                old = [part.column(i).cast(arrow.field(i).type) for i in range(n)]
                yield pa.RecordBatch.from_arrays([*old, *new], schema=arrow)
                del part, made, new, old
            release()

    bound_batches(df.sparkSession)
    return df.select(*names, *([text] if at == n else [])).mapInArrow(run, schema)

"""Text normalisation, fingerprints and Python-compatible JSON as columns.

Normalisation is NFKC, then case folding, then white space runs to one space, none at the
ends. Spark has neither of the first two. Texts in which both are known to change nothing
but case (ASCII and Latin-1 letters, the eszett written out) stay in the JVM; an Arrow
function sees only the others, and nulls in their place.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The code points that str.isspace calls white space, as a Java class.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
NOT_SPACE = SPACE.replace("[", "[^", 1)
#: A text with a character outside this class goes through the Arrow function.
NOT_SIMPLE = r"[^\x00-\x7f\xc0-\xff]"
REDACTED_WORDS = ("REDACTED", "[REDACTED]", "<REDACTED>")


def normalize(text: str) -> str:
    """The definition, for one text."""
    return " ".join(unicodedata.normalize("NFKC", text).casefold().split())


@F.arrow_udf(T.StringType())
def _normalize_batch(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else normalize(t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def _normalize_lists(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else [None if x is None else normalize(x) for x in t] for t in texts.to_pylist()], pa.list_(pa.string()))


def strip(text: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def _simple(text: Column) -> Column:
    folded = F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))
    return F.btrim(F.regexp_replace(folded, f"{SPACE}+", " "))


def normalized(text: Column) -> Column:
    """The normalised text; null for null."""
    odd = text.rlike(NOT_SIMPLE)
    return F.when(odd, _normalize_batch(F.when(odd, text))).otherwise(_simple(text))


def normalized_all(texts: Column) -> Column:
    """Each text of an array normalised."""
    odd = F.exists(texts, lambda t: t.rlike(NOT_SIMPLE))
    return F.when(odd, _normalize_lists(F.when(odd, texts))).otherwise(F.transform(texts, _simple))


def digest(norm: Column) -> Column:
    """Fingerprint of a normalised text."""
    return F.sha2(norm, 256)


def blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return text.isNull() | ~text.rlike(NOT_SPACE)


_SHORT = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
_LONG = {chr(c): f"\\u{c:04x}" for c in range(0x20) if chr(c) not in _SHORT}


def json_string(text: Column) -> Column:
    """A JSON string as Python's json.dumps writes it with ensure_ascii=False."""
    swap = lambda col, table: reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), table.items(), col)
    first = swap(text, {"\\": _SHORT["\\"]} | {k: v for k, v in _SHORT.items() if k != "\\"})
    whole = F.when(text.rlike(r"[\x00-\x07\x0b\x0e-\x1f]"), swap(first, _LONG)).otherwise(first)
    return F.concat(F.lit('"'), whole, F.lit('"'))


def json_list(*parts: Column) -> Column:
    """A JSON list of strings in Python's layout."""
    return F.concat(F.lit("["), F.concat_ws(", ", *[json_string(p) for p in parts]), F.lit("]"))


def json_object(**parts: Column) -> Column:
    """A JSON object of strings, in Python's layout and the given order."""
    fields = [F.concat(F.lit(f'"{k}": '), json_string(v)) for k, v in parts.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))


@F.arrow_udf(T.StructType([T.StructField("document_sha256", T.StringType()), T.StructField("example_id", T.StringType()), T.StructField("anchors", T.ArrayType(T.StringType()))]))
def record_fingerprints(task: pa.Array, instruction: pa.Array, query: pa.Array, document: pa.Array, groups: pa.Array) -> pa.Array:
    """Of whole records: the document's fingerprint, the example's, and the distinct ones of all texts to group by and the document, in order.

    Each text is normalised once for all three, with :func:`normalize`; equal to :func:`digest` and :func:`example_key` of :func:`normalized` texts.
    """
    sha = lambda norm: None if norm is None else hashlib.sha256(norm.encode()).hexdigest()
    norm = lambda text: None if text is None else normalize(text)
    short = lru_cache(maxsize=1024)(norm)  # instructions and queries are few
    out = []
    columns = (task, instruction, query, document, groups)
    rows = (r for at in range(0, len(document), 256) for r in zip(*[c.slice(at, 256).to_pylist() for c in columns], strict=True))
    for kind, policy, asked, text, others in rows:
        whole = norm(text)
        own = sha(whole)
        parts = [p for p in (kind, short(policy), short(asked), whole) if p is not None]
        anchors = None if others is None else {own, *(own if t == text else sha(norm(t)) for t in others)}
        out.append((own, sha(json.dumps(parts, ensure_ascii=False)), anchors and sorted(anchors, key=lambda a: (a is None, a or ""))))
    names = ("document_sha256", "example_id", "anchors")
    return pa.StructArray.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.list_(pa.string())))], names)


def example_key(task: Column, instruction: Column, query: Column, document: Column) -> Column:
    """Fingerprint of an example; all but the task come normalised."""
    return F.sha2(json_list(task, instruction, query, document), 256)


def is_redacted(text: Column) -> Column:
    return F.coalesce(F.upper(strip(text)).isin(*REDACTED_WORDS), F.lit(False))


def joined_text(parts: Column, name: str) -> Column:
    """An array of strings as one text, a line each; fails where that is blank."""
    text = F.array_join(parts, "\n")
    bad = parts.isNull() | F.exists(parts, lambda p: p.isNull()) | blank(text)
    return F.when(bad, F.raise_error(F.lit(f"unexpected field: {name}"))).otherwise(text)


def unit_draw(key: Column) -> Column:
    """A number from 0 to 1 by the first 64 bits of a key's SHA-256."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def first_byte_even(text: Column) -> Column:
    """Whether the first byte of the text's SHA-256 is even."""
    return F.conv(F.substring(F.sha2(text, 256), 2, 1), 16, 10).cast("int") % 2 == 0


def source_id(filename: Column, id_: Column, row_index: Column) -> Column:
    """``filename:id``; a missing, empty or zero id gives way to the row's number in its file."""
    own = F.when(id_.cast("string").isin("", "0"), None).otherwise(id_.cast("string"))
    return F.concat(filename, F.lit(":"), F.coalesce(own, row_index.cast("string")))

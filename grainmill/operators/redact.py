"""Redaction of documents with a token classifier, request bounds, and the gate on labels.

A classifier is anything that turns texts into labelled tokens. It runs once per Python
worker over Arrow batches, loaded lazily; decoding and redaction stay in the JVM. Model
weights are not part of this repository: :class:`OnnxTokenClassifier` takes a local folder.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.functions.spans import apply_redactions, bioes_spans, label_set, truncated
from grainmill.schemas import TOKENS

MAX_TOKENS = 4096
MAX_REQUEST_CHARS = 2_000_000
DECODE_MODE = "bioes_argmax"
BACKEND = "onnx"
#: Labels on which the gate fails unless others are given.
FAIL_ON = ("PRIVATE_EMAIL", "PRIVATE_PHONE", "ACCOUNT_NUMBER", "SECRET")


class RedactorError(RuntimeError):
    """The classifier can't be loaded or run."""


class TokenClassifier(Protocol):
    """Texts to their labelled tokens, ``(label, start, end)`` in code points."""

    def load(self) -> None: ...

    def classify(self, text: str) -> list[tuple[str, int, int]]: ...


@dataclass
class RedactionOptions:
    """Settings of the classifier; :meth:`from_environment` reads the variables of the same name."""

    model_id: str = ""
    onnx_model_file: str = "onnx/model_q4.onnx"
    providers: tuple[str, ...] = ("CPUExecutionProvider",)
    max_tokens: int = MAX_TOKENS

    @classmethod
    def from_environment(cls, env=os.environ) -> RedactionOptions:
        plain = cls()
        return cls(
            env.get("MODEL_ID", plain.model_id), env.get("ONNX_MODEL_FILE", plain.onnx_model_file),
            tuple(env.get("ORT_PROVIDERS", ",".join(plain.providers)).split(",")), int(env.get("ONNX_MAX_TOKENS", plain.max_tokens)),
        )


@dataclass
class OnnxTokenClassifier:
    """A token classification model in ONNX form from a local folder (``model_id``). Untested here: no weights."""

    options: RedactionOptions = field(default_factory=RedactionOptions)

    def load(self) -> None:
        if getattr(self, "_session", None) is not None:
            return
        try:
            import onnxruntime
            from tokenizers import Tokenizer

            folder = self.options.model_id
            with open(os.path.join(folder, "config.json"), encoding="utf-8") as f:
                self._labels = {int(k): v for k, v in json.load(f)["id2label"].items()}
            self._tokenizer = Tokenizer.from_file(os.path.join(folder, "tokenizer.json"))
            self._session = onnxruntime.InferenceSession(os.path.join(folder, self.options.onnx_model_file), providers=list(self.options.providers))
        except Exception as error:
            raise RedactorError(f"Failed to load ONNX privacy model: {error}") from error

    def classify(self, text: str) -> list[tuple[str, int, int]]:
        import numpy as np

        self.load()
        found = self._tokenizer.encode(text)
        ids = found.ids[: self.options.max_tokens]
        if not ids:
            return []
        batch = np.array([ids], np.int64)
        logits = self._session.run(None, {"input_ids": batch, "attention_mask": np.ones_like(batch)})[0][0]
        return [(self._labels[int(k)], a, b) for k, (a, b) in zip(logits.argmax(-1), found.offsets)]

    def info(self) -> dict:
        """Model facts; no providers and no bytes until it is loaded."""
        path = os.path.join(self.options.model_id, self.options.onnx_model_file)
        loaded = getattr(self, "_session", None) is not None
        return {
            "model_id": self.options.model_id, "onnx_model_file": self.options.onnx_model_file, "providers": self._session.get_providers() if loaded else [],
            "model_bytes": sum(os.path.getsize(p) for p in (path, f"{path}_data") if os.path.exists(p)) if loaded else 0, "model_path": path if loaded else "",
        }


#: Fixed patterns of the stand-in labeller: e-mail addresses and runs of nine digits or more.
FIXTURE_PATTERNS = {"private_email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "account_number": r"[0-9]{9,}"}


def fixture_tokens(text: Column) -> Column:
    """A stand-in labeller, for tests of the span operators only; it is no privacy model.

    White-space separated words are tokens; one that is an address or a long number as a
    whole is a single of that label, every other is outside.
    """
    words = F.split(text, r"[ \n]")
    zero = F.struct(F.array().cast(TOKENS).alias("t"), F.lit(0).alias("at"))

    def step(acc: Column, w: Column) -> Column:
        label = F.lit("O")
        for name, pattern in FIXTURE_PATTERNS.items():
            label = F.when(w.rlike(f"^{pattern}$"), f"S-{name}").otherwise(label)
        end = acc["at"] + F.length(w)
        token = F.struct(label.alias("label"), acc["at"].alias("start"), end.alias("end"))
        return F.struct(F.when(label == "O", acc["t"]).otherwise(F.concat(acc["t"], F.array(token))).alias("t"), (end + 1).alias("at"))

    return F.aggregate(words, zero, step, lambda acc: acc["t"])


def with_tokens(df: DataFrame, make: Callable[[], TokenClassifier], text_col: str = "text") -> DataFrame:
    """``df`` with ``tokens, elapsed_ms, error``: what the classifier says of each text.

    ``make`` runs once per task; a text on which the classifier fails has no tokens and its
    error, a classifier that can't be loaded fails the job.
    """
    schema = T.StructType([T.StructField("tokens", TOKENS), T.StructField("elapsed_ms", T.DoubleType()), T.StructField("error", T.StringType())])

    @F.arrow_udf(schema)
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = make()
        model.load()
        for texts in batches:
            rows = []
            for text in texts.to_pylist():
                began, tokens, error = time.perf_counter(), [], None
                try:
                    tokens = [{"label": a, "start": b, "end": c} for a, b, c in model.classify(text or "")]
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                rows.append({"tokens": tokens, "elapsed_ms": (time.perf_counter() - began) * 1000, "error": error})
            yield pa.array(rows, pa.struct([("tokens", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))), ("elapsed_ms", pa.float64()), ("error", pa.string())]))

    return df.withColumn("__c", classify(F.col(text_col))).select("*", "__c.*").drop("__c")


def redacted(df: DataFrame, tokens: Column, text_col: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``df`` with ``spans, redacted_text, labels, input_chars, output_chars``."""
    text = F.col(text_col)
    out = df.withColumn("spans", bioes_spans(text, truncated(tokens, max_tokens)))
    out = out.withColumn("redacted_text", apply_redactions(text, F.col("spans"))).withColumn("labels", label_set(F.col("spans")))
    return out.withColumns({"input_chars": F.length(text), "output_chars": F.length("redacted_text")})


def response(df: DataFrame, options: RedactionOptions) -> DataFrame:
    """The response row of every redacted text. ``error`` stands for a failed service call."""
    more = {"backend": F.lit(BACKEND), "model_id": F.lit(options.model_id), "onnx_model_file": F.lit(options.onnx_model_file), "decode_mode": F.lit(DECODE_MODE)}
    return df.withColumns({k: v for k, v in more.items() if k not in df.columns})


def within_bounds(text: Column) -> Column:
    return F.coalesce(F.length(text).between(1, MAX_REQUEST_CHARS), F.lit(False))


def gate(df: DataFrame, fail_on=FAIL_ON) -> DataFrame:
    """``df`` (with ``labels``) with ``matched`` and ``status``: FAIL where a text has a label of ``fail_on``."""
    matched = F.array_sort(F.array_intersect("labels", F.array(*map(F.lit, fail_on)).cast("array<string>")))
    return df.withColumn("matched", matched).withColumn("status", F.when(F.size("matched") > 0, "FAIL").otherwise("PASS"))


def gate_report(df: DataFrame, path: str = "path") -> DataFrame:
    """A line for each text, as the gate prints it."""
    labels = F.when(F.size("labels") > 0, F.array_join("labels", ",")).otherwise("-")
    line = F.concat_ws(" ", "status", F.col(path), F.concat(F.lit("backend="), F.lit(BACKEND)), F.concat(F.lit("elapsed_ms="), F.format_string("%.2f", F.coalesce("elapsed_ms", F.lit(0.0)))), F.concat(F.lit("labels="), labels))
    return df.select(F.col(path).alias("path"), "status", line.alias("line"))


def gate_exit_code(df: DataFrame) -> int:
    """2 if a text has an error, else 1 if one failed, else 0."""
    has_error = F.max(F.col("error").isNotNull().cast("int")) if "error" in df.columns else F.lit(0)
    row = df.agg(has_error.alias("e"), F.max((F.col("status") == "FAIL").cast("int")).alias("f")).first()
    return 2 if row["e"] else int(row["f"] or 0)

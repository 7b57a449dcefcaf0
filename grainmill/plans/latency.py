"""Latency benchmark of a classifier: cold load, warm-up, queries of a scenario, a JSON summary."""

from __future__ import annotations

import argparse
import json
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.operators.metrics import PERCENTILES, run_summary
from grainmill.operators.redact import OnnxTokenClassifier, RedactionOptions, TokenClassifier, redacted, with_tokens
from grainmill.runtime import settle
from grainmill.schemas import SAMPLE
from grainmill.sources.scans import json_lines

QUERIES, WARM_UP = 20, 3
#: One query after another on one core, or all at once on all of them.
SCENARIOS = ("SingleStream", "Offline")


def numbered_samples(spark: SparkSession, path: str) -> DataFrame:
    """``ordinal, id, text`` of a samples file, in its order; none at all fails."""
    rows = settle(json_lines(spark, path, SAMPLE).select("ordinal", F.col("id").cast("string").alias("id"), F.col("text").cast("string").alias("text")), "samples")
    if not rows.take(1):
        raise ValueError(f"no samples in {path}")
    return rows


def warm_up(samples: DataFrame, count: int) -> DataFrame:
    """The first samples, which are classified before anything is timed."""
    return samples.where(F.col("ordinal") < count)


def queries_of(samples: DataFrame, count: int, scenario: str) -> DataFrame:
    """``query`` numbers with the samples they take in turn."""
    n = samples.count()
    numbers = samples.sparkSession.range(count).withColumnRenamed("id", "query").withColumn("ordinal", F.col("query") % n)
    dealt = numbers.join(samples, "ordinal")
    return dealt.coalesce(1).sortWithinPartitions("query") if scenario == "SingleStream" else dealt.repartition(samples.sparkSession.sparkContext.defaultParallelism, "query")


def measure(spark: SparkSession, path: str, make: Callable[[], TokenClassifier], scenario: str = SCENARIOS[0], queries: int = QUERIES, warm: int = WARM_UP) -> dict:
    """The summary. Failed queries count with their latency; a classifier that can't be loaded fails."""
    if scenario not in SCENARIOS:
        raise ValueError(f"unknown scenario: {scenario}")
    samples = numbered_samples(spark, path)
    model = make()
    began = time.perf_counter()
    model.load()
    cold = (time.perf_counter() - began) * 1000
    for row in warm_up(samples, warm).collect():  # ``warm`` rows
        model.classify(row.text)
    dealt = settle(queries_of(samples, queries, scenario), "queries")
    began = time.perf_counter()
    done = redacted(with_tokens(dealt.coalesce(1) if scenario == "SingleStream" else dealt, make), F.col("tokens"))
    done = settle(done.select("query", "elapsed_ms", "error", "output_chars"), "answers")
    seconds = time.perf_counter() - began
    got = run_summary(done, seconds).first()
    info = getattr(model, "info", dict)()
    return {
        "scenario": scenario, "samples": samples.count(), "queries": got.completed, "failures": got.failures, "total_seconds": seconds, "samples_per_second": got.samples_per_second,
        "cold_model_load_ms": cold, "latency_ms": {k: got[f"{k}_ms"] for k in (*PERCENTILES, "mean")}, "model": {k: info.get(k) for k in ("model_id", "onnx_model_file", "model_bytes", "providers")},
    }


def main(argv: list[str] | None = None, spark: SparkSession | None = None, make: Callable[[], TokenClassifier] | None = None) -> int:
    """Prints the summary; 1 if a query failed."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--scenario", choices=SCENARIOS, default=SCENARIOS[0])
    parser.add_argument("--samples", required=True)
    parser.add_argument("--query-count", type=int, default=QUERIES)
    parser.add_argument("--warmup-samples", type=int, default=WARM_UP)
    args = parser.parse_args(argv)
    if spark is None:
        from grainmill.runtime import local_session

        spark = local_session()
    summary = measure(spark, args.samples, make or (lambda: OnnxTokenClassifier(RedactionOptions.from_environment())), args.scenario, args.query_count, args.warmup_samples)
    print(json.dumps(summary, indent=2))
    return 1 if summary["failures"] else 0


if __name__ == "__main__":
    sys.exit(main())

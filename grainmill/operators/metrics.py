"""Latency summaries with nearest-rank percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.runtime import settle

PERCENTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def rank_at(n: Column, fraction: float) -> Column:
    """Zero-based nearest rank of a percentile among ``n`` sorted values; halves round to even."""
    return F.bround((n - 1) * F.lit(fraction)).cast("long")


def latency_summary(df: DataFrame, value: str, group: str) -> DataFrame:
    """``group, p50, p90, p95, p99, mean`` of the values of each group; nulls don't count.

    Values are never gathered: distinct values are counted first, and ranks come from
    running counts in two levels of value ranges.
    """
    rows = df.select(F.col(group).alias("__g"), F.col(value).cast("double").alias("__v")).where("__v is not null")
    counts = settle(rows.groupBy("__g", "__v").agg(F.count(F.lit(1)).alias("__c")), "value-counts")
    facts = counts.groupBy("__g").agg(F.sum("__c").alias("__n"), (F.sum(F.col("__v") * F.col("__c")) / F.sum("__c")).alias("mean"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    facts = settle(facts, "value-facts")
    # up to 1024 ranges of a group's values keep a window's rows apart
    placed = counts.join(facts, counts["__g"].eqNullSafe(facts["__g"])).drop(facts["__g"])
    width = (F.col("__hi") - F.col("__lo")) / 1024
    placed = placed.withColumn("__r", F.when(width > 0, F.least(F.floor((F.col("__v") - F.col("__lo")) / width), F.lit(1023))).otherwise(F.lit(0)))
    sums = placed.groupBy("__g", "__r").agg(F.sum("__c").alias("__s"))
    before = Window.partitionBy("__g").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col("__g").alias("__bg"), F.col("__r").alias("__br"), F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__base"))
    own = F.sum("__c").over(Window.partitionBy("__g", "__r").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = placed.withColumn("__own", own).join(bases, F.col("__g").eqNullSafe(F.col("__bg")) & (F.col("__r") == F.col("__br")))
    upto = F.col("__base") + F.col("__own")
    hit = lambda f: F.max(F.when((upto > rank_at(F.col("__n"), f)) & (upto - F.col("__c") <= rank_at(F.col("__n"), f)), F.col("__v")))
    return ranked.groupBy(F.col("__g").alias(group)).agg(*[hit(f).alias(k) for k, f in PERCENTILES.items()], F.max("mean").alias("mean"))


def run_summary(df: DataFrame, seconds: float, elapsed: str = "elapsed_ms", error: str = "error") -> DataFrame:
    """One row: ``completed, failures, samples_per_second`` and the percentiles; failures count with their latency. No rows give zeros."""
    one = df.select(F.lit("all").alias("g"), F.col(elapsed).alias("v"), F.col(error).alias("e"))
    totals = one.agg(F.count(F.lit(1)).alias("completed"), F.count("e").alias("failures"))
    stats = latency_summary(one, "v", "g").drop("g")
    filled = [F.coalesce(k, F.lit(0.0)).alias(f"{k}_ms") for k in (*PERCENTILES, "mean")]
    rate = F.col("completed") / F.lit(float(seconds)) if seconds else F.lit(0.0)
    return totals.join(F.broadcast(stats), F.lit(True), "left").select("completed", "failures", rate.alias("samples_per_second"), *filled)  # both have one row at most

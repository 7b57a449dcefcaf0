"""Connected components of a graph given by its edges.

Alternating large-star and small-star rounds (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014): the number of rounds grows with the logarithm of the longest
path, each round moves rows in proportion to the edges, and only counts and checksums of
edges reach the driver. Least neighbours are pre-aggregated before they are shuffled; they
and each round's edges are written tables, so the joins on hubs have two plain shuffles as
inputs, which adaptive execution splits when one node has very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.runtime import forget, settle

MAX_ROUNDS = 100


def _oriented(edges: DataFrame, a, b) -> DataFrame:
    """Distinct edges ``u, v`` with u greater than v."""
    both = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    return both.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
    larger = both.where("v > u")
    large = settle(_oriented(larger.join(least, "u"), F.col("v"), F.col("m")), "cc-large")
    least2 = settle(large.groupBy("u").agg(F.min("v").alias("m")), "cc-least2")
    moved = large.join(least2, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    small = moved.unionByName(least2.select(F.col("u").alias("a"), F.col("m").alias("b")))
    out = settle(_oriented(small, F.col("a"), F.col("b")), "cc-small")
    forget(least, large, least2)
    return out


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node that has an edge to another; the component is its least node.

    Nodes may be of any ordered type. Loops, repeated edges and edges with a null end are
    ignored. An empty graph gives no rows.
    """
    now = settle(_oriented(edges, F.col(a), F.col(b)), "cc-edges")
    state = _state(now)
    for _ in range(MAX_ROUNDS if state[0] else 0):
        after = _round(now)
        changed = _state(after)
        forget(now)
        now = after
        if changed == state:
            break
        state = changed
    else:
        if state[0]:
            raise RuntimeError(f"no components after {MAX_ROUNDS} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)

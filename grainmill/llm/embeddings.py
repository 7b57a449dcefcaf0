"""Embedding near-dedup by a subspace pigeonhole join.

Vectors of one label are scaled to length one and rotated by a fixed random rotation, then
split into blocks of dimensions. A cosine of at least ``cosine`` is a squared distance of
at most ``2 - 2 * cosine``; a pair within it lies within the block's proportional part of
that budget in at least one block. So in every block a range join collects the pairs within
its part, and the union over blocks, which holds every pair sought, is verified by cosines of
the full vectors in double precision.

The range joins of all blocks run together, as block nested loops of matrix products: the
vectors of a label are dealt into chunks of about ``CHUNK``, and each pair of chunks is a task
of its own, to which both chunks go once. An index over a block was tried and isn't used: at
cosines of interest a block's radius is about as wide as its coordinates spread, so each cut or
cell of an index spares less work than its copies of rows at the borders add (see the README
for figures). Comparisons therefore grow with the square of a label, and so do copies of rows,
by one for each ``CHUNK`` vectors of the label. Vectors equal in label and components are one
class, so thousands of copies are one vector. Tasks return counts and a spanning forest of what
they linked, never pairs.

Defined results: null labels, and vectors that are null, empty, zero or hold null or
non-finite components link with nothing. Vectors of different lengths are not compared. Rows
alike in id and vector are vectors of their own. A null id is never the smallest of a
component unless it has no other; kept means that the id is its component's.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.arrow import bound_batches
from grainmill.operators.components import connected_components
from grainmill.runtime import forget, settle, small_enough

#: Dimensions of a block, about.
BLOCK = 16
CHUNK = 4096
#: Vectors of a chunk that meet the other chunk at a time.
TILE = 512
ROTATION_SEED = 20
#: A table with a row for each label is broadcast up to so many rows.
BROADCAST_LABELS = 100_000
#: Room for rounding in the distance tests, which work in single precision and only choose candidates.
SLACK = 1e-5
UNIT = ["__label", "dim", "hi", "gi"]


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """An orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([ROTATION_SEED, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_bounds(dim: int) -> list[tuple[int, int]]:
    n = max(1, round(dim / BLOCK))
    cuts = np.linspace(0, dim, n + 1).round().astype(int)
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def budgets(cosine: float, dim: int) -> list[tuple[int, int, float]]:
    """Each block's bounds and the squared distance within which it holds a candidate."""
    return [(lo, hi, (2 - 2 * cosine) * (hi - lo) / dim + SLACK) for lo, hi in block_bounds(dim)]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that no square overflows."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def candidates(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of ``x`` and ``y``, rotated and in single precision, are within a block's budget in some block."""
    near = np.zeros((len(x), len(y)), bool)
    for lo, hi, most in budgets(cosine, x.shape[1]):
        g, h = x[:, lo:hi], y[:, lo:hi]
        near |= (g * g).sum(1)[:, None] + (h * h).sum(1)[None, :] - 2 * (g @ h.T) <= np.float32(most)
    return near


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's component, of ``n`` nodes linked by pairs."""
    root = np.arange(n)
    while True:
        before = root
        root = root.copy()
        least = np.minimum(before[a], before[b])
        np.minimum.at(root, before[a], least)
        np.minimum.at(root, before[b], least)
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            return root


def compare(cosine: float):
    """A pair of chunks: for each class linked, how many vectors it is linked with there and its forest's root."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        column = lambda c: group.column(c).combine_chunks()
        names, members, away = column("class"), np.asarray(column("members")).astype(np.float64), np.asarray(column("guest"))
        dim, alone = group.column("dim")[0].as_py(), group.column("hi")[0] == group.column("gi")[0]
        x = unit(np.asarray(column("vector").flatten(), np.float64).reshape(-1, dim))
        turned = (x @ rotation(dim)).astype(np.float32)
        home = np.flatnonzero(~away)
        guest = home if alone else np.flatnonzero(away)
        found_a, found_b = [], []
        for start in range(0, len(home) if len(guest) else 0, TILE):
            tile = home[start : start + TILE]
            others = guest[start:] if alone else guest  # within one chunk a pair is met once
            i, j = np.nonzero(candidates(turned[tile], turned[others], cosine))
            i, j = tile[i], others[j]
            if alone:
                i, j = i[i < j], j[i < j]
            for s in range(0, len(i), 1 << 16):
                p, q = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                close = np.einsum("ij,ij->i", x[p], x[q]) >= cosine
                found_a.append(p[close])
                found_b.append(q[close])
        a = np.concatenate(found_a) if found_a else np.zeros(0, int)
        c = np.concatenate(found_b) if found_b else np.zeros(0, int)
        links = np.bincount(a, members[c], len(x)) + np.bincount(c, members[a], len(x))
        root = forest(a, c, len(x))
        at = np.flatnonzero(links)
        return pa.table({"class": names.take(pa.array(at)), "links": pa.array(links[at].astype(np.int64)), "root": names.take(pa.array(root[at]))})

    return run


def classes_of(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """The rows with ``__class``, null for those that link with nothing, and ``__label``."""
    v = F.col(vector_col)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    valid = v.isNotNull() & F.col(label_col).isNotNull() & (F.size(v) > 0) & F.forall(v, number) & F.exists(v, lambda x: x != 0)
    key = F.unhex(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), F.col(label_col), v)), 16, "0") for seed in ("one", "two")]))
    rows = df.select(F.col(id_col).alias("vec_id"), v.alias("vector"), F.col(label_col).cast("string").alias("__label"), F.when(F.coalesce(valid, F.lit(False)), key).alias("class"))
    return rows


def near_duplicates(df: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every vector."""
    rows = classes_of(df, id_col, vector_col, label_col)
    slim = settle(rows.select("vec_id", "class"), "vector-classes")
    alike = slim.where("class is not null").groupBy("class").agg(F.count(F.lit(1)).alias("members"), F.min("vec_id").alias("least"))
    classes = rows.where("class is not null").groupBy("class").agg(F.first("__label").alias("__label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("members"))
    classes = settle(classes.withColumn("dim", F.size("vector")), "classes")
    sizes = classes.groupBy("__label", "dim").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    sizes = settle(sizes, "label-chunks")
    dealt = classes.join(small_enough(sizes, BROADCAST_LABELS) or sizes, ["__label", "dim"])
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64(F.lit("chunk"), "class"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    units = dealt.select(
        "__label", "dim", F.least("mine", "other").alias("hi"), F.greatest("mine", "other").alias("gi"),
        (F.col("mine") > F.col("other")).alias("guest"), "class", "members", "vector",
    )
    bound_batches(df.sparkSession)
    found = units.groupBy(*UNIT).applyInArrow(compare(cosine), "class binary, links long, root binary")
    found = settle(found, "vector-links")

    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = connected_components(found, "class", "root").select(F.col("node").alias("class"), F.col("component").alias("group"))
    known = alike.join(links, "class", "left").join(groups, "class", "left").select(
        "class", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.coalesce("group", "class").alias("group"), "least"
    )
    known = settle(known, "class-facts")
    forget(classes, sizes, found)
    least = settle(known.groupBy("group").agg(F.min("least").alias("component_id")), "least-ids")
    facts = settle(known.join(least, "group").select("class", "n_links", "component_id"), "facts")
    forget(known, least)
    out = slim.join(facts, "class", "left")
    own = F.col("vec_id")
    component = F.when(F.col("class").isNull(), own).otherwise(F.col("component_id"))
    return out.select(own.alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), own.eqNullSafe(component).alias("kept"))

"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents stand in a shuffled order, by a hash of the id, and form an endless
stream of words that repeats after the source's size. The stream is cut into blocks of
equal words. The mix is a row of slots, one block each: slot ``i`` belongs to the point
``i * step mod slots``, where ``step`` is near ``slots`` times the golden ratio and coprime
to ``slots``, and the point falls into a source's range of the cumulative targets. So every
stretch of slots holds each source in about its share, each source gets just the slots its
target needs, and its slots, ranked by position, take its blocks in order.

Targets: sources in code-point order, null last, weigh 1, 2, 3, repeating, and share the
words of all sources; no target exceeds ``most_repeats`` times its source's size, and what
is above is shared again by weight. So no document is taken more often than that.

Running sums over a source are made in three levels of a hash's bytes, so that a source
with a third of all rows is dealt over many tasks; only a row for each source goes to the
driver. Ranks of slots are worked out from the schedule by arithmetic in the same manner.

Defined results: null and empty texts have size 0 and are taken 0 words. A table without
words gives targets of 0. Repeated rows, also of one id, are documents of their own. Extra
columns are ignored. The order depends on ids and texts alone, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainmill.llm.lines import with_row_hash
from grainmill.runtime import settle

#: A word is a run of characters other than the space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights by rank of the source, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
BLOCK_WORDS = 16_384
MOST_REPEATS = 3
#: Slots of the schedule for each task that makes them, about.
TASK_SLOTS = 200_000
#: A table of sources up to this many rows is broadcast.
BROADCAST_SOURCES = 10_000


def word_count(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], most_repeats: int) -> list[float]:
    """Words to take from each source: ``weights`` share the sum of ``sizes`` under the caps."""
    out, open_, rest = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s > 0}, float(sum(sizes))
    while open_:
        level = rest / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] > most_repeats * sizes[i]}
        if not over:
            for i in open_:
                out[i] = level * weights[i]
            break
        for i in over:
            out[i] = float(most_repeats * sizes[i])
            rest -= out[i]
        open_ -= over
    return out


def golden_step(slots: int) -> int:
    """A number near ``slots`` over the golden ratio that is coprime to it."""
    step = max(1, round(slots * (math.sqrt(5) - 1) / 2))
    while math.gcd(step, slots) != 1:
        step += 1
    return step


class Mix:
    """The parts of a mix: ``documents`` (with the columns to ``carry``), ``sources``, ``schedule`` and what is ``taken``."""

    def __init__(self, df: DataFrame, id_col="doc_id", text_col="text", source_col="source", block_words=BLOCK_WORDS, most_repeats=MOST_REPEATS, seed="mix", carry=()):
        self.spark, self.block = df.sparkSession, block_words
        rows = df.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("__source"), word_count(text_col).alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("__h"), *carry,
        )
        rows = settle(rows, "mix-sizes")
        found = rows.groupBy("__source").agg(F.sum("size")).collect()  # a row for each source
        found.sort(key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")))  # UTF-8 order is code-point order
        sizes = [int(r[1]) for r in found]
        want = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))], most_repeats)
        stop = [min(round(t), most_repeats * s) for t, s in zip(want, sizes)]
        slots = [-(-s // block_words) for s in stop]
        self.total = sum(slots)
        low, table = 0, []
        for i, r in enumerate(found):
            table.append((r[0], i, sizes[i], want[i], stop[i], low, slots[i]))
            low += slots[i]
        self.sources = self.spark.createDataFrame(
            table, "__source string, __s int, source_size long, target double, __stop long, __low long, __slots long"
        )
        side = F.broadcast(self.sources) if len(table) <= BROADCAST_SOURCES else self.sources
        self.documents = self._placed(rows.join(side, rows["__source"].eqNullSafe(side["__source"])).drop("__source"))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Documents with ``__at``, where their words begin in their source's stream."""
        byte = lambda k: F.shiftrightunsigned("__h", 64 - 8 * k).bitwiseAND(F.lit(255)).cast("int")
        rows = rows.withColumn("__b1", byte(1)).withColumn("__b2", byte(2))
        fine = rows.groupBy("__s", "__b1", "__b2").agg(F.sum("size").alias("__sum"))
        before = lambda keys, order: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        run = lambda w: F.coalesce(F.sum("__sum").over(w), F.lit(0))
        coarse = fine.groupBy("__s", "__b1").agg(F.sum("__sum").alias("__sum"))
        base1 = coarse.select("__s", "__b1", run(before(["__s"], "__b1")).alias("__base1"))  # 256 rows for a source
        base2 = fine.select("__s", "__b1", "__b2", run(before(["__s", "__b1"], "__b2")).alias("__base2"))
        bases = base2.join(base1, ["__s", "__b1"]).select("__s", "__b1", "__b2", (F.col("__base1") + F.col("__base2")).alias("__base"))
        order = Window.partitionBy("__s", "__b1", "__b2").orderBy("__h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
        own = rows.withColumn("__own", F.coalesce(F.sum("size").over(order), F.lit(0)))
        return own.join(bases, ["__s", "__b1", "__b2"]).withColumn("__at", F.col("__base") + F.col("__own")).drop("__b1", "__b2", "__base", "__own", "__h")

    def schedule(self) -> DataFrame:
        """``position, __s, rank``: the source of every slot of the mix and the block of its stream it takes.

        Points are numbered along the cumulative targets, so a source owns the points from
        ``__low``. The rank of a slot among its source's is a running count over positions,
        made in two levels of position.
        """
        n, step = self.total, golden_step(max(1, self.total))
        chunk = max(1, math.isqrt(n))
        owned = self.sources.where("__slots > 0").select("__s", "__low", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__slots - 1) div {chunk}"))).alias("__c"), "__slots")
        owned = owned.repartition(1 + n // TASK_SLOTS, "__s", "__c")  # else a source's slots all come from the task with its row
        points = owned.select("__s", F.explode(F.expr(f"sequence(__low + __c * {chunk}, __low + least((__c + 1) * {chunk}, __slots) - 1)")).alias("__p"))
        back = pow(step, -1, n) if n > 1 else 0
        exact = F.col("__p").cast("decimal(19,0)") * F.lit(back).cast("decimal(19,0)")
        slots = points.select("__s", F.expr("__p").alias("__p"), (exact % F.lit(max(1, n)).cast("decimal(19,0)")).cast("long").alias("position"))
        slots = slots.withColumn("__g", F.expr(f"position div {chunk}"))
        groups = slots.groupBy("__s", "__g").agg(F.count(F.lit(1)).alias("__n"))
        run = Window.partitionBy("__s").orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
        bases = groups.select("__s", "__g", F.coalesce(F.sum("__n").over(run), F.lit(0)).alias("__base"))
        number = F.row_number().over(Window.partitionBy("__s", "__g").orderBy("position")) - 1
        ranked = slots.withColumn("__number", number).join(bases, ["__s", "__g"])
        return ranked.select("position", "__s", (F.col("__base") + F.col("__number")).alias("rank"))

    def segments(self) -> DataFrame:
        """What each slot takes from each document: ``position, pass, __from, length`` in words, with the document's columns.

        Documents meet the slots by source and block number; a document longer than a block
        spans several.
        """
        b, at = self.block, F.col("__pass") * F.col("source_size") + F.col("__at")
        used = self.documents.where("size > 0 and __at < __stop").select(
            "*", F.explode(F.expr("sequence(0, cast(ceil(__stop / source_size) as int) - 1)")).alias("__pass")
        )
        spans = used.withColumn("__begin", at).withColumn("__end", F.least(at + F.col("size"), F.col("__stop"))).where("__begin < __end")
        cut = spans.select("*", F.explode(F.expr(f"sequence(__begin div {b}, (__end - 1) div {b})")).alias("rank"))
        cut = cut.withColumn("__from", F.greatest(F.col("__begin"), F.col("rank") * b) - F.col("__begin"))
        cut = cut.withColumn("length", F.least(F.col("__end"), (F.col("rank") + 1) * b) - F.col("__begin") - F.col("__from"))
        return cut.join(self.schedule(), ["__s", "rank"])

    def taken(self) -> DataFrame:
        """``doc_id, size, source_size, target, taken`` of every document."""
        own = ["doc_id", "size", "source_size", "target"]
        got = self.segments().select(*own, "__s", "__at", "length")
        none = self.documents.where("size = 0 or __at >= __stop").select(*own, F.lit(0).cast("long").alias("taken"))
        some = got.groupBy(*own, "__s", "__at").agg(F.sum("length").cast("long").alias("taken")).select(*own, "taken")
        return some.unionByName(none)


def mix(df: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    return Mix(df, **options).taken()


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as whole rows of ``df``: a row for each pass over a document that the mix takes.

    The schedule's slots say how many words of a document each pass takes; where the last
    block of a source ends inside a document, its last copy is in if at least half of its
    words are. Documents without words are no part of the mix. Only row hashes and sizes
    meet the schedule; whole rows are shuffled once, to meet the number of their copies.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = with_row_hash(df.toDF(*names), *names)
    id_, text, source = (names[df.columns.index(c)] for c in (id_col, text_col, source_col))
    mixed = Mix(plain, id_, text, source, carry=("r1", "r2"), **options)
    passes = mixed.segments().groupBy("r1", "r2", "__at", "size", "__pass").agg(F.sum("length").alias("__in"))
    copies = passes.where(2 * F.col("__in") >= F.col("size")).groupBy("r1", "r2").agg(F.count(F.lit(1)).cast("int").alias("__copies"))
    copies = settle(copies, "mix-copies")
    # copies of rows alike in every column are counted together, so one of the rows stands for all
    alike = mixed.documents.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    whole = plain.dropDuplicates(["r1", "r2"]) if alike.take(1) else plain
    rows = whole.join(copies, ["r1", "r2"]).select(*names, F.explode(F.sequence(F.lit(1), "__copies")).alias("__copy"))
    return rows.select(names).toDF(*df.columns)

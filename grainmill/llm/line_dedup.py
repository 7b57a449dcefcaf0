"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only.

A first look at the documents writes a row for each of their lines, with the hash of its key
and whether it is the key's first line in its document, in one folder for each batch. A batch's
keys are counted by document. A merge anti-join with the runs of frequent keys takes out what
is known already; merge joins with the other runs, on every level, add what earlier batches
counted. Keys whose count has reached the limit become a run of frequent keys, the others a
run of level 0 with the batch's own counts. When ``FANOUT`` runs stand on a level, they are
merged into one of the next level, without the keys that have become frequent since. Runs are
tables bucketed and sorted by key, so all these joins merge bucket by bucket: only the batch's
own counts are shuffled. A key's last batch meets all its counts, so after the last batch
the frequent keys are complete.

A key is a line with white space stripped from both ends and A to Z lower-cased; keys of
at least ``min_chars`` code points that at least ``min_docs`` documents hold lose all their
lines everywhere; other lines stay, joined by line feeds. A second look at the documents
takes them out by the line numbers that the first look wrote.

Skew: counts are pre-aggregated before every shuffle, so a line in a third of all documents
is a row per task. The frequent keys are broadcast only up to ``BROADCAST_KEYS`` rows; more
go through a sort-merge join of two written tables, which adaptive execution splits.

Defined results: a null or empty text is one empty line, which is never dropped. Each row
is a document, also if it repeats another's id or is alike in id and text. Other columns are
ignored by :func:`dedup_lines` and passed on by :func:`without_frequent_lines`. Time is in
proportion to a document's lines (times the logarithm of their number, to sort their hashes).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.llm.lines import bind, key_hash, line_key, with_row_hash, without_places
from grainmill.runtime import delete_path, forget, scratch_path, settle, small_enough

BATCHES = 4
FANOUT = 3
BROADCAST_KEYS = 200_000
KEY = ["k1", "k2"]


class Run:
    """A table of keys, bucketed and sorted by them, under the shared folder."""

    def __init__(self, rows: DataFrame, buckets: int):
        self.spark = rows.sparkSession
        self.name, self.path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "line-run")
        rows.write.option("path", self.path).bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(self.name)
        self.rows = self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.path)


class LineRuns:
    """The levels of runs and the runs of frequent keys."""

    def __init__(self, spark: SparkSession, min_docs: int):
        self.min_docs = min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[Run]] = [[]]
        self.frequent: list[Run] = []

    def add(self, keys: DataFrame) -> None:
        """A batch: a row ``k1, k2`` for each document and distinct key."""
        fresh = self._unknown(keys.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")))
        met = self._beside(fresh, [r for level in self.levels for r in level], "left")
        batch = Run(met.select(*KEY, F.col("n"), _sum(met).alias("total")), self.buckets)
        reached = F.col("total") >= self.min_docs
        self.frequent.append(Run(batch.rows.where(reached).select(*KEY), self.buckets))
        batch.rows = batch.rows.where(~reached).select(*KEY, "n")
        self._put(batch, 0)

    def close(self) -> DataFrame:
        """The frequent keys, written; the runs are gone."""
        rows = [r.rows for r in self.frequent]
        found = settle(reduce(DataFrame.unionByName, rows), "frequent-lines")
        for run in [*self.frequent, *(r for level in self.levels for r in level)]:
            run.drop()
        return found

    def _unknown(self, rows: DataFrame) -> DataFrame:
        return reduce(lambda left, run: left.join(run.rows, KEY, "left_anti"), self.frequent, rows)

    def _beside(self, rows: DataFrame, runs: list[Run], how: str) -> DataFrame:
        """``rows`` with a column for the counts of each run."""
        return reduce(lambda left, x: left.join(x[1].rows.withColumnRenamed("n", f"n{x[0]}"), KEY, how), enumerate(runs), rows)

    def _put(self, run: Run, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == FANOUT:
            runs, self.levels[level] = self.levels[level], []
            merged = self._unknown(self._beside(runs[0].rows, runs[1:], "full_outer"))
            self._put(Run(merged.select(*KEY, _sum(merged).alias("n")), self.buckets), level + 1)
            for old in runs:
                old.drop()


def _sum(rows: DataFrame) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in rows.columns if c not in KEY])


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _entries(text: str, min_chars: int) -> Column:
    """``k1, k2, pos, first`` of each line with a key, in order of key and position."""
    keyed = F.transform(_lines(text), lambda x, i: bind(line_key(x), lambda k: F.when(F.length(k) >= min_chars, F.struct(*[key_hash(k)[c].alias(c) for c in KEY], i.alias("pos")))))
    follows = lambda x, y: F.coalesce((x["k1"] == y["k1"]) & (x["k2"] == y["k2"]), F.lit(False))
    marked = lambda s: F.transform(s, lambda x, i: F.struct(x["k1"].alias("k1"), x["k2"].alias("k2"), x["pos"].alias("pos"), (~follows(x, F.get(s, i - 1))).alias("first")))
    return bind(F.sort_array(F.filter(keyed, lambda x: x.isNotNull())), marked)


def line_table(df: DataFrame, min_chars: int, text_col: str, ids: list[str], batches: int) -> DataFrame:
    """``r1, r2, pos, k1, k2, first, batch`` of every line, written; batches are dealt by a hash of the text and cover all rows."""
    spark = df.sparkSession
    batch = F.pmod(F.coalesce(F.xxhash64(text_col), F.lit(0)), F.lit(batches)).cast("int").alias("batch")
    rows = with_row_hash(df, *ids, text_col).select("r1", "r2", batch, F.explode(_entries(text_col, min_chars)).alias("x")).select("r1", "r2", "x.pos", "x.k1", "x.k2", "x.first", "batch")
    path = scratch_path(spark, "lines")
    rows.write.partitionBy("batch").parquet(path)
    out = spark.read.schema(rows.schema).parquet(path)
    out._grainmill_path = path
    return out


def frequent_lines(lines: DataFrame, min_docs: int, batches: int = BATCHES) -> DataFrame:
    """``k1, k2`` of the keys to drop, from a :func:`line_table`."""
    runs = LineRuns(lines.sparkSession, min_docs)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b).where("first").select(*KEY))
    return runs.close()


def _marked(df: DataFrame, min_docs: int, min_chars: int, text_col: str, ids: list[str], batches: int) -> DataFrame:
    """``df`` with ``__drop``, the numbers of the lines to drop (null: none)."""
    lines = line_table(df, min_chars, text_col, ids, batches)
    frequent = frequent_lines(lines, min_docs, batches)
    hits = lines.join(small_enough(frequent, BROADCAST_KEYS) or frequent, KEY)
    dropped = settle(hits.groupBy("r1", "r2").agg(F.collect_set("pos").alias("__drop")), "dropped")
    forget(lines, frequent)
    return with_row_hash(df, *ids, text_col).join(dropped, ["r1", "r2"], "left").drop("r1", "r2")


def _kept(text_col: str) -> Column:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.when(F.col("__drop").isNull(), text).otherwise(without_places(text, F.col("__drop")))


def dedup_lines(df: DataFrame, min_docs: int, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """``id_col, n_lines, n_dropped, kept_text`` of every document."""
    marked = _marked(df.select(id_col, text_col), min_docs, min_chars, text_col, [id_col], batches)
    return marked.select(
        id_col, F.size(_lines(text_col)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"), _kept(text_col).alias("kept_text"),
    )


def without_frequent_lines(df: DataFrame, min_docs: int, min_chars: int = 1, text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """The rows of ``df``, all columns, their texts without the frequent lines. A null text stays null."""
    names = [f"c{i}" for i in range(len(df.columns))]
    text = names[df.columns.index(text_col)]
    marked = _marked(df.toDF(*names), min_docs, min_chars, text, names, batches)
    kept = F.when(F.col(text).isNotNull(), _kept(text)).alias(text)
    return marked.select(*[kept if n == text else n for n in names]).toDF(*df.columns)

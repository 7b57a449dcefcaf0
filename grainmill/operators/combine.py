"""Canonical records to training examples: groups, split protection, conflicts, exact dedup, audit.

Records that share an anchor (a normalised group text or document) form a group, through
others too. Of a group only the records of its highest split stay (test, validation,
train); train groups go to validation by a draw on the group. Among the records that stay,
examples with two answers go, and equal examples become one with all its origins.

What is written and shuffled is a slim row for each record: fingerprints, keys and the short
columns. Each step is made when a result first asks for it, so counts and orders never meet
texts. Whole texts are read from the records again and meet the chosen rows once, by a hash of
the row; they are shuffled again only if records of one example share the order's first four
columns, and then only those that were chosen. Group and example facts are aggregated before
they are shuffled and come back by joins, not windows, so one giant group is no giant task.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.text import blank, record_fingerprints, unit_draw
from grainmill.operators.components import connected_components
from grainmill.runtime import forget, settle
from grainmill.schemas import ANSWERS, EVALUATION_ONLY, REQUIRED, SPLIT_RANK, SPLITS, SYSTEM_PROMPT, TASKS

SEED, VALIDATION_FRACTION = 42, 0.05
#: Records of an example stand in the order of these and the document; the first gives the example.
HEAD = ("source", "source_id", "task", "source_split")
ORDER = (*HEAD, "document")


def rank_of(split: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in SPLIT_RANK.items() for x in kv])[split]


def split_of(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SPLITS)), rank + 1)


def violation() -> Column:
    """What is wrong with a canonical record, the first in the order of the checks; null if nothing."""
    out = None
    for name in REQUIRED:
        bad = blank(F.col(name))
        out = F.when(bad, F.lit(f"{name} is blank")) if out is None else out.when(bad, F.lit(f"{name} is blank"))
    groups = F.col("group_texts")
    for bad, what in (
        (~F.col("source_split").isin(*SPLITS), "the split is none of the known ones"),
        (~F.col("task").isin(*TASKS) | ~F.col("answer").isin(*ANSWERS), "the task or the answer is none of the known ones"),
        (groups.isNull() | (F.size(groups) == 0), "nothing to group by"),
        (F.exists(groups, blank), "a text to group by is blank"),
        ((F.col("source") == EVALUATION_ONLY) & (F.col("source_split") != "test"), f"{EVALUATION_ONLY} is for tests alone"),
    ):
        out = out.when(bad, F.lit(what))
    return out


def validate(records: DataFrame) -> DataFrame:
    """The records; raises before anything is written if one is invalid."""
    _refuse(records.select(violation().alias("v")))
    return records


def _refuse(said: DataFrame) -> None:
    """Raises if a record has a violation (column ``v``)."""
    wrong = said.where("v is not null").groupBy("v").count().orderBy("v").limit(20).collect()
    if wrong:
        raise ValueError("invalid records: " + ", ".join(f"{r[0]} ({r[1]})" for r in wrong))


def fingerprinted(records: DataFrame) -> DataFrame:
    """Records with ``rank, document_sha256, anchors, example_id``."""
    prints = record_fingerprints("task", "instruction", "query", "document", "group_texts")
    out = records.withColumns({"rank": rank_of(F.col("source_split")), "__f": prints})
    return out.withColumns({c: F.col(f"__f.{c}") for c in ("document_sha256", "example_id", "anchors")}).drop("__f")


def anchor_edges(records: DataFrame) -> DataFrame:
    """``anchor_a, anchor_b``: a record's least anchor with each of its others."""
    return records.select(F.col("anchors")[0].alias("anchor_a"), F.explode(F.slice("anchors", 2, F.greatest(F.size("anchors") - 1, F.lit(0)))).alias("anchor_b")).distinct()


#: The columns that decide, without texts.
SLIM = ("k1", "k2", "source", "source_id", "task", "source_split", "rank", "answer", "provenance", "document_sha256", "example_id", "anchors")


#: Rows of whole texts in a batch for the Python function that fingerprints them.
BATCH_ROWS = 512


def slim(records: DataFrame, *more: Column) -> DataFrame:
    """Fingerprinted records without their texts, with ``k1, k2``, 128 bits of the whole row."""
    return records.withColumns(row_keys()).select(*SLIM, *more)


def row_keys() -> dict[str, Column]:
    cols = [F.col(c) for c in (*ORDER, "instruction", "query", "answer", "provenance")]
    return {"k1": F.xxhash64(*cols), "k2": F.xxhash64(F.lit("second"), *cols)}


def grouped(records: DataFrame) -> DataFrame:
    """Records (slim ones at scale) with ``group_id``, the least anchor of their group, dropped records included."""
    edges = anchor_edges(records).select(F.unhex("anchor_a").alias("a"), F.unhex("anchor_b").alias("b"))  # half as many bytes, in the same order
    parts = connected_components(edges).select(*[F.lower(F.hex(c)).alias(c) for c in ("node", "component")])
    first = records.withColumn("__a", F.col("anchors")[0]).drop("anchors")
    return first.join(settle(parts, "groups"), F.col("__a") == F.col("node"), "left").withColumn("group_id", F.coalesce("component", "__a")).drop("__a", "node", "component")


def group_facts(records: DataFrame, seed: int = SEED, fraction: float = VALIDATION_FRACTION) -> DataFrame:
    """``group_id, highest_split, target`` of every group."""
    highest = records.groupBy("group_id").agg(F.max("rank").alias("highest"))
    draw = unit_draw(F.concat(F.lit(f"{seed}:"), F.col("group_id")))
    target = F.when((F.col("highest") == 0) & (draw < fraction), "validation").otherwise(split_of(F.col("highest")))
    return highest.select("group_id", "highest", split_of(F.col("highest")).alias("highest_split"), target.alias("target"))


class Combined:
    """The combination of a set of canonical records, which must give the same rows whenever they are read.

    ``flagged`` has every record with its ``group_id``, ``target`` and ``fate`` (overlap,
    conflict, duplicate or kept), without long texts; ``examples`` has the examples, ``chosen``
    the same without texts.
    """

    def __init__(self, records: DataFrame, seed: int = SEED, fraction: float = VALIDATION_FRACTION):
        if not 0 <= fraction < 1:
            raise ValueError("the validation fraction must be in [0, 1)")
        self.records, self.seed, self.fraction = records, seed, fraction
        self.rows = settle(slim(fingerprinted(records), violation().alias("v")), "records", BATCH_ROWS)
        try:
            _refuse(self.rows)
        except ValueError:
            forget(self.rows)
            raise

    @cached_property
    def named(self) -> DataFrame:
        """Slim records with their groups."""
        out = settle(grouped(self.rows.select(*SLIM)), "grouped")
        forget(self.rows)
        return out

    @cached_property
    def facts(self) -> DataFrame:
        return settle(group_facts(self.named, self.seed, self.fraction), "group-facts")

    @cached_property
    def whole(self) -> DataFrame:
        return self.named.join(self.facts, "group_id")

    @cached_property
    def stays(self) -> DataFrame:
        return settle(self.whole.where("rank = highest"), "staying")

    @cached_property
    def answers(self) -> DataFrame:
        """``example_id, n_answers, n_records`` of the examples whose records stay."""
        given = F.size(F.collect_set("answer")).cast("long")  # at most as many as there are answers
        return settle(self.stays.groupBy("example_id").agg(given.alias("n_answers"), F.count(F.lit(1)).alias("n_records")), "answers")

    @property
    def conflicts(self) -> DataFrame:
        """``example_id, n_answers`` of the examples that go because they have several answers."""
        return self.answers.where("n_answers > 1").select("example_id", "n_answers")

    @property
    def _told(self) -> DataFrame:
        return self.stays.join(self.answers.select("example_id", (F.col("n_answers") > 1).alias("conflict")), "example_id")

    @cached_property
    def flagged(self) -> DataFrame:
        short = lambda df, fate: df.select("source", "group_id", "example_id", "source_split", "target", fate.alias("fate"))
        gone = short(self.whole.where("rank < highest"), F.lit("overlap"))
        return settle(gone.unionByName(short(self._told, F.when(F.col("conflict"), "conflict").otherwise("agreed"))), "flagged")

    @cached_property
    def chosen(self) -> DataFrame:
        """One row for each example: its first record, without its texts, and all its origins."""
        blank_ = F.coalesce(F.col("provenance"), F.lit("")).isin("", "{}")
        origin = F.struct("source", "source_id", "task", "source_split", F.when(~blank_, F.col("provenance")).alias("provenance"))
        best = self.stays.groupBy("example_id").agg(
            F.min(F.struct(*HEAD, "k1", "k2")).alias("r"), F.array_sort(F.collect_set(origin)).alias("o"), F.count(F.lit(1)).alias("n_records"),
            *[F.first(c).alias(c) for c in ("group_id", "target", "document_sha256", "answer")], (F.min("answer") < F.max("answer")).alias("conflict"),
        )
        origins = F.transform("o", lambda x: F.struct(x["source"].alias("source"), x["source_id"].alias("source_id"), x["source_split"].alias("source_split"), x["provenance"].alias("provenance")))
        return settle(best.where("not conflict").select(
            "example_id", "group_id", F.col("target").alias("split"), "document_sha256", "answer", *[F.col(f"r.{c}").alias(c) for c in (*HEAD, "k1", "k2")], origins.alias("origins"), "n_records",
        ), "chosen")

    @cached_property
    def examples(self) -> DataFrame:
        """The examples with their texts, which are joined each time that this is read."""
        best = self.chosen.drop("answer")
        keys = [F.col(c).eqNullSafe(F.col(f"r.{c}")) for c in HEAD]
        texts = self.records.withColumns(row_keys()).select("k1", "k2", "document", "instruction", "query", "answer", F.coalesce("provenance", F.lit("")).alias("provenance"))
        if self.stays.groupBy("example_id", *HEAD).count().where("count > 1").take(1):  # the text decides which of them is first
            tied = self.stays.join(best.select("example_id", F.struct(*HEAD).alias("r")), "example_id").where(keys[0] & keys[1] & keys[2] & keys[3])
            tied = settle(tied.select("example_id", "k1", "k2").distinct(), "tied")
            first = F.min(F.struct("document", "instruction", "query", "answer", "provenance")).alias("t")
            found = tied.join(texts, ["k1", "k2"]).groupBy("example_id").agg(first).select("example_id", "t.*")
            full = best.join(found, "example_id")
        else:
            full = best.join(texts, ["k1", "k2"])
        return full.select(
            "example_id", "group_id", "split", "document_sha256", *HEAD, "document", "instruction", "query", "answer",
            F.when(F.col("provenance") == "", "{}").otherwise(F.col("provenance")).alias("provenance"), "origins", "n_records",
        )

    def audit(self) -> DataFrame:
        """``counter, n``: the counters of the combination; the dropped ones only where not zero."""
        n, many = F.count(F.lit(1)), F.col("n_answers") > 1
        some = lambda c, when: F.coalesce(F.sum(F.when(when, c)), F.lit(0))
        kept = self.answers.agg(
            F.count(F.when(many, 1)).alias("conflicting_example_keys"), F.coalesce(F.sum("n_records"), F.lit(0)).alias("__stay"),
            some(F.col("n_records"), many).alias("dropped_conflicting_labels"), some(F.col("n_records") - 1, ~many).alias("dropped_duplicates"),
        )
        one = lambda df: F.broadcast(df)  # noqa: E731  a row each
        totals = self.named.agg(n.alias("input_records")).join(one(self.facts.agg(n.alias("document_groups"))), F.lit(True)).join(one(kept), F.lit(True))
        totals = totals.withColumn("dropped_split_overlap", F.col("input_records") - F.col("__stay")).drop("__stay")
        names = ["input_records", "document_groups", "conflicting_example_keys", "dropped_split_overlap", "dropped_conflicting_labels", "dropped_duplicates"]
        long = totals.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(n).cast("long") for n in names]))).alias("counter", "n"))
        always = F.col("counter").isin("input_records", "document_groups", "conflicting_example_keys")
        return long.where(always | (F.col("n") > 0))

    def overlap_by_source(self) -> DataFrame:
        return self.whole.where("rank < highest").groupBy("source").agg(F.count(F.lit(1)).alias("n"))

    def split_counts(self) -> DataFrame:
        """``split, dimension, key, n``: counts of the examples, by one pass over grouping sets."""
        return split_counts(self.chosen)

    def messages(self) -> DataFrame:
        """Chat examples: ``example_id, split, messages, metadata``."""
        return chat_messages(self.examples)

    def shuffled(self, seed: int = SEED) -> DataFrame:
        """``split, pos, example_id``: a fixed shuffled order of each split, by a hash of seed and example."""
        return shuffled(self.chosen, seed)


def split_counts(examples: DataFrame) -> DataFrame:
    keyed = examples.select("split", "source", "task", F.concat_ws(":", "task", "answer").alias("task_answer"))
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), k.alias("key")) for d, k in (("records", F.lit("")), ("by_source", F.col("source")), ("by_task", F.col("task")), ("by_task_answer", F.col("task_answer")))]))
    return keyed.select("split", pairs.alias("p")).groupBy("split", "p.dimension", "p.key").agg(F.count(F.lit(1)).alias("n"))


def user_message() -> Column:
    return F.concat(F.lit("<Instruct>: "), "instruction", F.lit("\n\n<Query>: "), "query", F.lit("\n\n<Document>: "), "document")


def chat_messages(examples: DataFrame) -> DataFrame:
    """Fields stand in alphabetical order, so their JSON has sorted keys."""
    message = lambda role, content: F.struct(content.alias("content"), F.lit(role).alias("role"))
    origins = F.transform("origins", lambda o: F.struct(o["provenance"].alias("provenance"), o["source"].alias("source"), o["source_id"].alias("source_id"), o["source_split"].alias("source_split")))
    metadata = F.struct(
        "answer", "document_sha256", "example_id", "group_id", origins.alias("origins"), "provenance", "source", "source_id", "source_split", "split", "task"
    )
    return examples.select("example_id", "split", F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", user_message()), message("assistant", F.col("answer"))).alias("messages"), metadata.alias("metadata"))


def shuffle_key(seed: int = SEED) -> Column:
    """What a split's shuffled order goes by, before the example."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), "example_id"), 256)


def shuffled(examples: DataFrame, seed: int = SEED) -> DataFrame:
    """Positions are counted in two levels of the order's first byte, so no split is one task."""
    keyed = examples.select("split", "example_id", shuffle_key(seed).alias("__o"))
    keyed = keyed.withColumn("__b", F.substring("__o", 1, 3))
    sizes = keyed.groupBy("split", "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("split").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("split", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    number = F.row_number().over(Window.partitionBy("split", "__b").orderBy("__o", "example_id")) - 1
    return keyed.withColumn("__k", number).join(bases, ["split", "__b"]).select("split", (F.col("__base") + F.col("__k")).cast("long").alias("pos"), "example_id")


def leaking_groups(examples: DataFrame) -> DataFrame:
    """Groups that stand in two splits; must be empty."""
    return examples.groupBy("group_id").agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a <> b").select("group_id")


def group_leaks(examples: DataFrame) -> DataFrame:
    """``n_groups, n_leaking``: the groups of the examples, and those that stand in two splits, in one pass."""
    spread = examples.groupBy("group_id").agg((F.min("split") < F.max("split")).alias("leaks"))
    return spread.agg(F.count(F.lit(1)).alias("n_groups"), F.count(F.when(F.col("leaks"), 1)).alias("n_leaking"))

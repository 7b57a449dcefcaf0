"""Quality rules with line frequencies across documents. DataFrame functions only.

Each line is normalised (white space stripped at both ends, A to Z lower-cased) and hashed;
for each host the distinct documents that hold it are counted. Lines above ``max_docs``
documents of their host are removed, and a document is depleted, so rejected, when less
than ``least_left`` of the characters of its lines remain. Rules on the document alone are
checked first: too few words, or too many words in repeated five-word windows.

Skew: a document's distinct lines are taken in its row and counts are pre-aggregated before
the shuffle, so a line that every document holds is a row per task. The keys above the limit
are broadcast up to ``BROADCAST_KEYS`` rows; beyond, two written tables are sort-merge
joined, which adaptive execution splits.

Defined results: a null or empty text has no words and fails the base rules. Lines without
a character other than white space are neither counted nor removed. Each row is a document,
also if it repeats another's id or is alike in id, host and text. A null host is a host. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.llm.lines import SPACES, bind, key_hash, line_key, with_row_hash, without_places
from grainmill.runtime import settle, small_enough

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
MAX_DOCS_PER_HOST = 100
LEAST_LEFT = 0.5
BROADCAST_KEYS = 200_000


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, from a bound array of word hashes."""
    starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    def covered(grams: Column) -> Column:
        ranked = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def total(s: Column) -> Column:
            twin = lambda x, k: F.coalesce(x["g"] == F.get(s, k)["g"], F.lit(False))
            again = F.filter(s, lambda x, k: twin(x, k - 1) | twin(x, k + 1))
            places = F.array_sort(F.transform(again, lambda x: x["i"]))
            step = lambda acc, p: F.struct((p + WINDOW).alias("end"), (acc["n"] + WINDOW - F.greatest(acc["end"] - p, F.lit(0))).alias("n"))
            return F.aggregate(places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step)["n"]

        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(bind(ranked, total))

    return F.when(F.size(hashes) <= WINDOW, F.lit(0)).otherwise(bind(windows, covered))


def base_metrics(text: Column) -> dict[str, Column]:
    """The metrics of a text that is not null, as columns of longs."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    word = bind(F.transform(words(text), lambda w: F.xxhash64(w)), lambda h: F.struct(F.size(h).alias("n"), repeated_words(h).alias("again")))
    long = lambda c: c.cast("long")
    return {
        "__word": word,
        "word_chars": long(F.length(F.translate(text, SPACES, ""))),
        "n_symbols": long(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))),
        "n_dup_lines": bind(lines, lambda x: long(F.size(x) - F.size(F.array_distinct(x)))),
    }


def _own(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """``doc_id, text, host`` with the hash ``r1, r2`` of the three."""
    own = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(host_col).cast("string").alias("host"))
    return with_row_hash(own, "doc_id", "text", "host")


def _keys(text: str) -> Column:
    """The key of each line of a text; empty where it is blank."""
    return F.transform(F.split(text, "\n"), line_key)


def _hits(own: DataFrame, max_docs: int) -> DataFrame:
    """``r1, r2`` of the rows that hold common lines of their host, with their lines, characters and distinct places ``__gone``."""
    # keys are made distinct as texts, which takes time in proportion to their number, and hashed after
    distinct = own.select("host", F.explode(F.array_distinct(_keys("text"))).alias("k")).where("k <> ''").select("host", key_hash(F.col("k")).alias("k"))
    counts = distinct.groupBy("host", "k.k1", "k.k2").agg(F.count(F.lit(1)).alias("n_docs"))
    common = settle(counts.where(F.col("n_docs") > max_docs).select(F.col("host").alias("__host"), "k1", "k2"), "common-lines")

    lines = own.select("r1", "r2", "host", F.posexplode(_keys("text")).alias("pos", "k")).where("k <> ''")
    lines = lines.select("r1", "r2", "host", "pos", F.length("k").alias("chars"), key_hash(F.col("k")).alias("k")).select("r1", "r2", "host", "pos", "chars", "k.k1", "k.k2")
    near = small_enough(common, BROADCAST_KEYS) or common
    hit = (lines["k1"] == near["k1"]) & (lines["k2"] == near["k2"]) & lines["host"].eqNullSafe(near["__host"])
    return lines.join(near, hit).groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("__lines"), F.sum("chars").alias("__chars"), F.collect_set("pos").alias("__gone"))


def without_common_lines(
    df: DataFrame, max_docs: int = MAX_DOCS_PER_HOST, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """The rows of ``df``, all columns, their texts without the lines that :func:`judge` counts as removed. A null text stays null."""
    names = [f"c{i}" for i in range(len(df.columns))]
    id_, text, host = (names[df.columns.index(c)] for c in (id_col, text_col, host_col))
    plain = df.toDF(*names)
    gone = settle(_hits(_own(plain, id_, text, host), max_docs).select("r1", "r2", "__gone"), "gone-lines")
    marked = plain.withColumns({"__text": F.coalesce(text, F.lit("")), "__host": F.col(host).cast("string")})
    marked = with_row_hash(marked, id_, "__text", "__host").join(gone, ["r1", "r2"], "left")
    kept = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(without_places(F.col(text), F.col("__gone"))).alias(text)
    return marked.select(*[kept if n == text else n for n in names]).toDF(*df.columns)


def judge(
    df: DataFrame, max_docs: int = MAX_DOCS_PER_HOST, least_left: float = LEAST_LEFT,
    id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
) -> DataFrame:
    """Metrics and verdict of every document: ``id_col``, the base metrics, ``n_lines_removed, share_left, base_failed, kept``."""
    own = _own(df, id_col, text_col, host_col)
    total = F.aggregate(_keys("text"), F.lit(0).cast("long"), lambda a, k: a + F.length(k))
    slim = own.select("doc_id", "r1", "r2", total.alias("__total"), *[c.alias(n) for n, c in base_metrics(F.col("text")).items()])
    # rows alike in id, host and text have one hash and their hits are summed over all of them
    alike = own.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1")
    found = _hits(own, max_docs).join(alike, ["r1", "r2"], "left").select(
        "r1", "r2", (F.col("__lines") / F.coalesce("__rows", F.lit(1))).cast("long").alias("__lines"), (F.col("__chars") / F.coalesce("__rows", F.lit(1))).cast("long").alias("__chars")
    )
    out = slim.join(settle(found, "removed-lines"), ["r1", "r2"], "left")
    n_words, again = F.col("__word.n"), F.col("__word.again")
    failed = (n_words < MIN_WORDS) | (100 * again > MAX_REPEATED_PERCENT * n_words)
    left = F.when(F.col("__total") > 0, 1 - F.coalesce("__chars", F.lit(0)) / F.col("__total")).otherwise(F.lit(1.0))
    return out.select(
        F.col("doc_id").alias(id_col), n_words.cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", again.cast("long").alias("n_repeat_words"),
        F.coalesce("__lines", F.lit(0)).cast("long").alias("n_lines_removed"), left.alias("share_left"),
        failed.alias("base_failed"), (~failed & (left >= least_left)).alias("kept"),
    )

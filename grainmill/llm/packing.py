"""Best-fit packing with exact complements.

Documents become token ids plus an end id; those longer than the capacity are cut into
pieces of it. Packing works on the histogram of piece lengths, which has at most
``capacity`` entries whatever the number of documents, so its plan is made on the driver:
the longest length left opens a sequence; single lengths, then pairs, then triples that
exactly fill the gap are looked up and consumed under their availability counts; where
there are none the longest length that fits goes in and the search repeats. One pattern is
used as many times as the counts allow. The index of length sums isn't stored: a mask of
the lengths that are left, laid over itself in reverse, shows all pairs with a given sum at
once. Residuals are fitted from the sequence's side, the longest piece that fits into the
one open gap, not from the piece's side into the tightest of many gaps. Pieces find their
place by their rank within their length, counted in salted groups, so that a length which a
third of all pieces share is dealt over many tasks. No text or id is shuffled.

Defined results: a null or empty text is a piece of the end id alone; repeated rows are
pieces of their own; an empty table gives no rows; other columns are ignored. Reruns give
the same placement up to exchange of identical rows.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.llm.arrow import map_texts
from grainmill.runtime import settle

#: Words whose ids a worker remembers, at some 30 bytes each; beyond it the memory starts afresh.
CACHE_WORDS = 700_000
#: Rows of a batch while texts are cut.
PIECE_ROWS = 2000
#: Words handed to the library at a time.
CALL_WORDS = 4096


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes in: printable ones stand for themselves, others come behind in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordIds:
    """Token ids of whole texts under a vocabulary whose tokens never cross white space.

    Such a vocabulary drops white space before it merges, so a text's ids are those of its
    words in a row, and each distinct word is encoded once for as long as it is remembered.
    What is remembered stands in four flat arrays: words by 128 bits of a hash, in order of
    the first 64, and where their ids begin in one array of all ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.table = byte_letters()
        probes = ["a", "letters", "LETTERS", "straße", "déjà", "Ñandú", "œuvre", "zzxqj", "ż", "ﬁ"]
        self.plain = all(self.merged(w) in (None, e.ids) for w, e in zip(probes, self.tokenizer.encode_batch_fast(probes, add_special_tokens=False)))
        self.forget()

    def merged(self, word: str) -> list[int] | None:
        """Ids of a word of Latin letters alone, by the merges without the steps before them, which leave it whole; None for others."""
        if word.isascii():
            word = word.lower()
        elif self.tokenizer.normalizer is None or max(word := self.tokenizer.normalizer.normalize_str(word)) >= "\u0250":
            return None
        else:
            word, letters = word.encode().decode("latin-1").translate(self.table), word.isalpha()
            return [t.id for t in self.tokenizer.model.tokenize(word)] if letters else None
        return [t.id for t in self.tokenizer.model.tokenize(word)] if word.isalpha() else None

    def forget(self) -> None:
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.known = np.zeros(0, "<u4")

    def letters(self, stem: str) -> bool:
        """Whether a stem stays letters alone when the vocabulary has normalised it; some letters become a letter and a mark."""
        return stem.isalpha() and (stem.isascii() or self.tokenizer.normalizer is None or self.tokenizer.normalizer.normalize_str(stem).isalpha())

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, and where in it each word's begin and how many they are."""
        if len(self.key) > CACHE_WORDS:
            self.forget()
        hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w.encode()) for w in words), ">u8").reshape(-1, 2).astype(np.uint64)
        at = self._places(hashes)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            missing = missing[np.unique(hashes[missing], axis=0, return_index=True)[1]]
            ids = [self.merged(words[i]) if self.plain and words[i] else None for i in missing]
            left = [k for k, found in enumerate(ids) if found is None]
            for start in range(0, len(left), CALL_WORDS):
                part = left[start : start + CALL_WORDS]
                for k, e in zip(part, self.tokenizer.encode_batch_fast([words[missing[k]] for k in part], add_special_tokens=False)):
                    ids[k] = e.ids
            size = np.fromiter(map(len, ids), np.int32, len(ids))
            start = len(self.known) + np.cumsum(size, dtype=np.int64) - size
            self.known = np.concatenate([self.known, np.fromiter((x for e in ids for x in e), "<u4", int(size.sum()))])
            key = np.concatenate([self.key, hashes[missing, 0]])
            order = np.argsort(key, kind="stable")
            self.key, self.check = key[order], np.concatenate([self.check, hashes[missing, 1]])[order]
            self.start, self.size = np.concatenate([self.start, start])[order], np.concatenate([self.size, size])[order]
            at = self._places(hashes)
        return self.known, self.start[at], self.size[at].astype(np.int64)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash is remembered; -1 if it isn't."""
        at = np.searchsorted(self.key, hashes[:, 0])
        out = np.full(len(hashes), -1)
        for step in range(2):  # words alike in the first 64 bits stand side by side
            there = at + step < len(self.key)
            k = np.where(there, at + step, 0)
            if len(self.key):
                hit = there & (self.key[k] == hashes[:, 0]) & (self.check[k] == hashes[:, 1])
                out[hit] = k[hit]
        return out

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; none for null."""
        texts = texts.fill_null("")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # a special token's string keeps its case
            texts = pc.ascii_lower(texts)
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        codes, bounds = coded.indices.to_numpy(), words.offsets.to_numpy()
        parts = coded.dictionary.to_pylist()
        # a letter run and the mark behind it are tokens of their own
        dot, comma = (np.asarray(pc.ends_with(coded.dictionary, m)) for m in ".,")
        cut = dot | comma
        for k in np.flatnonzero(cut).tolist():
            stem = parts[k][:-1]
            if self.letters(stem):
                parts[k] = stem
            else:
                cut[k] = False
        known, first, size = self.encode([*parts, ",", "."])
        mark = len(parts) + dot.astype(np.int64)
        # ids of each distinct word and its mark in a row, then those of all words of all texts
        whole, sizes = gathered(known, np.stack([first[:-2], first[mark]], 1).ravel(), np.stack([size[:-2], np.where(cut, size[mark], 0)], 1).ravel())
        sizes = sizes.reshape(-1, 2).sum(1)
        flat, each = gathered(whole, (np.cumsum(sizes) - sizes)[codes], sizes[codes])
        ends = np.concatenate([[0], np.cumsum(each)])[bounds - bounds[0]]
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def gathered(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``ids`` that begin there and are so long, in a row, and their sizes."""
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return ids[at], size


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut_pieces(
    df: DataFrame, vocabulary: str, capacity: int, end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32`` (and ``ids``) of every piece of every text."""

    def run(texts: pa.Array) -> dict:
        out = {"__length": [], "__crc": [], "__ids": []}
        for ids in word_ids(vocabulary).ids(texts):
            whole = np.append(ids, np.uint32(end_id)).astype("<u4")
            parts = [whole[i : i + capacity] for i in range(0, len(whole), capacity)]
            out["__length"].append([len(p) for p in parts])
            out["__crc"].append([zlib.crc32(p.tobytes()) for p in parts])
            if with_ids:
                out["__ids"].append([p.tolist() for p in parts])
        return out

    fields = [T.StructField("__length", T.ArrayType(T.LongType())), T.StructField("__crc", T.ArrayType(T.LongType()))]
    if with_ids:
        fields.append(T.StructField("__ids", T.ArrayType(T.ArrayType(T.LongType()))))
    cut = map_texts(df, [id_col], text_col, run, fields)
    cut = cut.select(id_col, F.posexplode(F.arrays_zip(*[f.name for f in fields])).alias("piece", "__p"))
    out = cut.select(
        id_col, F.col("piece").cast("int").alias("piece"), (F.col("piece").cast("long") * capacity).alias("start"),
        F.col("__p.__length").alias("length"), F.col("__p.__crc").alias("ids_crc32"), *([F.col("__p.__ids").alias("ids")] if with_ids else []),
    )
    return out


def plan(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Where the pieces of each length go.

    Rows, ordered by length and rank: the ranks from ``low`` of ``length`` go, ``uses`` to a
    sequence and one after another from ``offset`` on, into the sequences from ``sequence``.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    there = left > 0
    ranked = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0

    while there.any():
        uses: dict[int, int] = {}
        free = there  # lengths with a piece that the pattern hasn't taken yet

        def take(length: int) -> None:
            nonlocal free
            uses[length] = uses.get(length, 0) + 1
            if uses[length] == left[length]:
                free = free.copy()
                free[length] = False

        def remaining(length: int) -> int:
            return int(left[length]) - uses.get(length, 0)

        def pair(total: int, beside: int = 0) -> tuple[int, int] | None:
            """The pair of free lengths with that sum whose longer one is longest, a piece of length ``beside`` being taken."""
            if total < 2:
                return None
            there_still = free
            if beside and remaining(beside) == 1:
                there_still = free.copy()
                there_still[beside] = False
            both = there_still[1:total] & there_still[total - 1 : 0 : -1]
            half = total // 2
            longer = np.flatnonzero(both[half - 1 + (total % 2) :])
            for k in longer[::-1]:
                a = half + (total % 2) + int(k)
                if a != total - a or remaining(a) - (a == beside) >= 2:
                    return a, total - a
            return None

        def complement(gap: int) -> tuple[int, ...] | None:
            if free[gap]:
                return (gap,)
            if found := pair(gap):
                return found
            for a in np.flatnonzero(free[:gap])[::-1]:
                a = int(a)
                if 3 * a < gap:
                    break
                if found := pair(gap - a, a):
                    return a, *found
            return None

        take(int(np.flatnonzero(there)[-1]))
        gap = capacity - next(iter(uses))
        while gap:
            longest = np.flatnonzero(free[: gap + 1])
            if not len(longest):
                break
            # three of the longest must reach the gap, else no triple can
            found = complement(gap) if 3 * int(longest[-1]) >= gap else None
            for length in found or (int(longest[-1]),):
                take(length)
                gap -= length
        times = min(int(left[x]) // n for x, n in uses.items())
        offset = 0
        for x, n in uses.items():
            rows.append((x, int(ranked[x]), n, sequence, offset))
            ranked[x] += times * n
            left[x] -= times * n
            there[x] = left[x] > 0
            offset += x * n
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "low", "uses", "sequence", "offset"), cols)) | {"sequences": np.array([sequence])}


def ranked_by_length(pieces: DataFrame, most: int, id_col: str) -> DataFrame:
    """``pieces`` with ``__rank``, numbers from 0 within each length.

    Pieces of a length are dealt over about the square root of ``most`` (the largest
    count) groups by a hash; a piece's rank is its number in its group plus the sizes of
    the groups before.
    """
    salts = max(1, int(np.ceil(np.sqrt(most))))
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64(F.col(id_col), "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    order = Window.partitionBy("length", "__salt").orderBy(id_col, "piece", "ids_crc32")
    numbered = salted.withColumn("__number", F.row_number().over(order) - 1)
    return numbered.join(bases, ["length", "__salt"]).withColumn("__rank", F.col("__base") + F.col("__number"))


def pack(pieces: DataFrame, capacity: int, id_col: str = "doc_id") -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``pieces`` should be a written table, as it is read twice."""
    spark = pieces.sparkSession
    counts = {int(r[0]): r[1] for r in pieces.groupBy("length").count().collect()}  # at most a row for each length up to capacity
    shared = spark.sparkContext.broadcast(plan(counts, capacity))  # a few rows for each length
    ranked = ranked_by_length(pieces, max(counts.values(), default=1), id_col)
    own = pieces.schema.fields
    schema = T.StructType([*own, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        table = shared.value
        key = table["length"] << 44 | table["low"]  # fewer than 2**44 pieces of a length
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("__rank").to_numpy().astype(np.int64)
            at = np.searchsorted(key, length << 44 | rank, side="right") - 1
            sequence, within = np.divmod(rank - table["low"][at], table["uses"][at])
            new = [pa.array(table["sequence"][at] + sequence), pa.array(table["offset"][at] + within * length)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in own], *new], names=[f.name for f in schema.fields])

    return ranked.select(*[f.name for f in own], "__rank").mapInArrow(place, schema)


def pack_documents(df: DataFrame, vocabulary: str, capacity: int, end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut and pack all texts; a row for each piece."""
    return pack(settle(cut_pieces(df, vocabulary, capacity, end_id, with_ids, id_col, text_col), "pieces", PIECE_ROWS), capacity, id_col)


def assemble(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the ids of each sequence, from pieces packed ``with_ids``. A sequence has at most the capacity."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(placed, lambda p: p["ids"])).alias("ids"))

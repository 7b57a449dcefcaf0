"""Near-dedup of documents with SuperMinHash signatures.

1. A document's distinct word shingles are hashed to 64 bits. Documents with equal sets are
   one class, known by 128 bits of the set; thousands of copies are one class from here on.
2. SuperMinHash (Ertl, 2017): every element draws a random rank for each signature place
   through a random permutation of its own, so its ranks are spread over the places, which
   lowers the variance; elements stop as soon as no later rank can matter. All elements of a
   batch of documents take a step together.
3. ``BANDS`` bands of ``ROWS`` places make buckets. In each bucket the least class is the
   pivot and every other member is a candidate pair with it: pairs grow with the members, not
   with their square. Sizes and then signature sketches sort out hopeless pairs; the rest is
   verified exactly on the full sets of both texts.
4. Verified links are grouped by union-find: within each partition by a forest in Python,
   across partitions by the star rounds of :mod:`grainmill.operators.components`.
5. Buckets in which members are still outside the pivot's component are looked at once more:
   those outside meet all members of other components, in chunks dealt over tasks, first by
   size and sketch. Texts are fetched for the members of likely pairs alone, which tasks then
   verify on the spot; they give a forest of links, not pairs. So no two members of a bucket
   that could link stay uncompared unless they are already in one component.

At the threshold of 0.8 a pair misses all 32 bands of 4 rows with probability 5e-8, and the
sketch test (5 standard deviations below the threshold) with at most 6e-7, the binomial tail.

Words: A to Z lower-cased, runs of other characters than the space and U+0009 to U+000D.
Defined results: a text with fewer words than a shingle has one shingle, its words; without
words, or null, it has none and links with nothing. Rows alike in id and text are documents
of their own. Null ids are never the smallest of a component that has another.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.arrow import bound_batches, release, slices
from grainmill.llm.lines import with_row_hash
from grainmill.operators.components import connected_components
from grainmill.runtime import forget, settle, small_enough

BANDS, ROWS = 32, 4
PLACES = BANDS * ROWS
#: Members of a crowded bucket are dealt into chunks of this size.
CHUNK = 256
#: Texts of candidate classes are picked out by a broadcast list of up to so many rows.
BROADCAST_ROWS = 500_000
#: Rows of a batch that hold a whole text, and that hold two.
TEXT_ROWS, PAIR_ROWS = 2000, 400
#: Bits of a rank below the step's number.
STEP_BITS = 57
SLICE_BYTES = 1 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64's)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    of = np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in words), np.uint64, len(words))
    codes = coded.indices.to_numpy()
    bounds = lists.offsets.to_numpy()
    bounds = bounds - bounds[0]
    if "" in words:  # white space at the ends of a text
        real = codes != words.index("")
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
        codes = codes[real]
    hashed = of[codes]
    n = len(hashed)
    rolled = np.full(n, size, np.uint64)
    if n >= size:
        rolled = rolled[: n - size + 1]
        for k in range(size):
            rolled = mix(rolled * _U(0x9E3779B97F4A7C15) + hashed[k : n - size + 1 + k])
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mix(whole * _U(0x9E3779B97F4A7C15) + hashed[k : k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def superminhash(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """The signature of each set, a row each; a place holds the step and rank of its least element."""
    docs, most = len(sets), ~_U(0)
    h = np.full((docs, places), most, np.uint64)
    flat = h.reshape(-1)
    x = np.concatenate(sets) if docs else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(docs), [len(s) for s in sets])
    order = None  # of each active element: what stands at each place of its permutation
    with np.errstate(over="ignore"):
        for j in range(places):
            if not len(x):
                break
            draw = mix(x + _U((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            k = j + (((mix(draw) >> _U(32)) * _U(places - j)) >> _U(32)).astype(np.int64)
            rows = np.arange(len(x))
            place = k if order is None else order[rows, k].astype(np.int64)
            np.minimum.at(flat, doc * places + place, (_U(j) << _U(STEP_BITS)) | (draw >> _U(64 - STEP_BITS)))
            going = np.flatnonzero(h.max(axis=1) >= _U(j + 1) << _U(STEP_BITS)) if j + 1 < places else []
            live = np.zeros(docs, bool)
            live[going] = True
            stay = live[doc]
            if order is None:
                x, doc, k = x[stay], doc[stay], k[stay]
                order = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (len(x), 1))
                order[np.arange(len(x)), k] = 0
            else:
                order[rows, k] = order[:, j]
                x, doc, order = x[stay], doc[stay], order[stay]
    return h


def sign(shingle: int, keep: list[str]):
    """Rows with a text become rows with the set's size and, if it isn't empty, its class, band hashes and sketch."""
    width = len(keep)

    def run(batches):
        for batch in batches:
            for wide in slices(batch, width):
                for part in _by_bytes(wide, width):
                    sets = shingle_sets(part.column(width), shingle)
                    full = [s for s in sets if len(s)]
                    marks = mix(superminhash(full))
                    bands = np.full((len(full), BANDS), 7, np.uint64)
                    for r in range(ROWS):
                        bands = mix(bands * _U(0x9E3779B97F4A7C15) + marks[:, r::ROWS])
                    sketch = (marks & _U(255)).astype(np.uint8)
                    at = iter(range(len(full)))
                    index = [next(at) if len(s) else None for s in sets]
                    yield pa.RecordBatch.from_arrays(
                        [
                            *part.columns[:width], pa.array([len(s) for s in sets], pa.int64()),
                            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                            pa.array([None if i is None else bands[i].view(np.int64) for i in index], pa.list_(pa.int64())),
                            pa.array([None if i is None else sketch[i].tobytes() for i in index], pa.binary()),
                        ],
                        names=[*keep, "n", "class", "bands", "sketch"],
                    )
                    del sets, full, marks, bands, sketch, part
                release()

    return run


def _by_bytes(batch: pa.RecordBatch, sized: int):
    """Smaller slices, as signatures need some hundred bytes for each word."""
    sizes = np.asarray(pc.binary_length(batch.column(sized)).fill_null(0)).cumsum()
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, base + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def least_matches(percent: int) -> int:
    """Equal places of two sketches below which a pair isn't verified."""
    p = percent / 100
    return int(PLACES * p - 5 * np.sqrt(PLACES * p * (1 - p)))


def sketches_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PLACES)


def plausible(least: int):
    """Pairs whose sketches agree in enough places."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                same = (sketches_of(batch.column("sa")) == sketches_of(batch.column("sb"))).sum(1)
                at = pa.array(same >= least)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(at), batch.column("b").filter(at)], names=["a", "b"])

    return run


def verified(shingle: int, percent: int):
    """Pairs with their texts become the links among them, as a forest for each batch."""

    def run(batches):
        for batch in batches:
            for wide in slices(batch, 2):
                for part in _by_bytes(wide, 3):
                    texts = pa.concat_arrays([part.column(2), part.column(3)]).dictionary_encode()
                    sets = shingle_sets(texts.dictionary, shingle)
                    codes = texts.indices.to_numpy()
                    n, links = part.num_rows, []
                    for i, (x, y) in enumerate(zip(codes[:n], codes[n:])):
                        if similar(sets[x], sets[y], percent):
                            links.append(i)
                    a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
                    yield _binary_rows(union_find([(a[i], b[i]) for i in links]))
                    del sets, texts, part
                release()

    return run


def union_find(links: list[tuple]) -> list[tuple]:
    """Each linked node with the least node of its component; no row for that node itself."""
    parent: dict = {}

    def find(x):
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, r) for x in parent if (r := find(x)) != x]


def _binary_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], names=["a", "b"])


#: What is known of a member of a bucket where it is compared, apart from its marks and text.
MEMBER = "band int, value long, hi int, gi int, class binary, n long, component binary, loose boolean, outside boolean"


class Unit:
    """A chunk of members outside the pivot's component against a chunk of members.

    ``pairs`` are those that pass the sketch test, the likeliest first. A pair is looked at in
    the first band it shares alone, told from the hashes that made the buckets: there too one
    of the two is outside, unless one is the pivot, which has met the other already.
    """

    def __init__(self, group: pa.Table, percent: int, least: int):
        self.group = group.combine_chunks()
        outside, loose, n = (np.asarray(self.column(c)) for c in ("outside", "loose", "n"))
        home, away = np.flatnonzero(outside), np.flatnonzero(~outside)
        self.names, parts = (np.array(self.column(c).to_pylist(), dtype=object) for c in ("class", "component"))
        number, self.codes = (np.unique(x, return_inverse=True)[1] for x in (self.names, parts))
        sketch, band = sketches_of(self.column("sketch")), self.group.column("band")[0].as_py()
        bands = np.asarray(self.column("bands").flatten()).reshape(-1, BANDS)
        self.pairs = []
        for i in home:
            ok = (self.codes[away] != self.codes[i]) & (100 * np.minimum(n[away], n[i]) >= percent * np.maximum(n[away], n[i]))
            ok &= ~loose[away] | (number[away] > number[i])  # two members outside meet twice
            j = away[ok]
            matches = (sketch[j] == sketch[i]).sum(1)
            fit = (matches >= least) & ((bands[j] == bands[i]).argmax(1) == band)
            self.pairs += [(-int(m), int(i), int(k)) for m, k in zip(matches[fit], j[fit])]
        self.pairs.sort()
        self.rows = np.unique([k for p in self.pairs for k in p[1:]]).astype(np.int64)

    def column(self, name: str) -> pa.Array:
        return self.group.column(name).combine_chunks()


def likely_members(percent: int, least: int):
    """The members of a unit that are in one of its pairs; their texts alone are needed."""
    names = [f.split()[0] for f in MEMBER.split(", ")]

    def run(group: pa.Table) -> pa.Table:
        unit = Unit(group, percent, least)
        found = unit.group.select(names).take(pa.array(unit.rows))
        del unit
        if group.num_rows >= CHUNK:
            release()
        return found

    return run


def outside_links(shingle: int, percent: int, least: int):
    """The links of a unit that join components.

    Pairs are verified on the full sets, unless links found before have joined their
    components; so at most a link for each component comes out.
    """

    def run(group: pa.Table) -> pa.Table:
        unit = Unit(group, percent, least)
        sets = dict(zip(unit.rows.tolist(), shingle_sets(unit.column("text").take(pa.array(unit.rows)), shingle))) if len(unit.rows) else {}
        joined, found = list(range(len(unit.names))), []

        def find(x: int) -> int:
            while joined[x] != x:
                joined[x] = joined[joined[x]]
                x = joined[x]
            return x

        for _, i, k in unit.pairs:
            a, b = find(int(unit.codes[i])), find(int(unit.codes[k]))
            if a != b and similar(sets[i], sets[k], percent):
                joined[max(a, b)] = min(a, b)
                found.append((unit.names[i], unit.names[k]))
        return pa.Table.from_batches([_binary_rows(found)])

    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


class NearDuplicates:
    """Classes of documents and their components.

    ``signed`` has a row for each document with ``keep``'s columns, ``n`` and ``class``;
    ``facts`` has ``class`` and ``component`` for every class that holds words.
    """

    def __init__(self, df: DataFrame, shingle: int, percent: int, key: list[str], text_col: str):
        self.shingle, self.percent, self.text_col = shingle, percent, text_col
        self.least = least_matches(percent)
        bound_batches(df.sparkSession)
        #: Rows by which a text is found again: 128 bits of the key's columns.
        self.rows = with_row_hash(df, *key)
        head = self.rows.select(*key[:1], "r1", "r2", text_col).withColumnRenamed(key[0], "__id").toDF("__id", "r1", "r2", "__text")
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in head.schema.fields[:3])
        schema = f"{kinds}, n long, class binary, bands array<long>, sketch binary"
        signed = settle(head.mapInArrow(sign(shingle, ["__id", "r1", "r2"]), schema), "signatures", TEXT_ROWS)
        self.signed = signed.select("__id", "r1", "r2", "n", "class")
        one = signed.where("class is not null").groupBy("class").agg(F.min(F.struct("r1", "r2")).alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        self.classes = settle(one, "set-classes")
        self.sketches = self.classes.select("class", "n", "sketch")
        members = self.classes.select(F.posexplode("bands").alias("band", "value"), "class", "n")
        pivots = members.groupBy("band", "value").agg(F.min(F.struct("class", "n")).alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1")
        self.pivots = settle(pivots, "pivots")
        self.members = settle(members.join(self.pivots, ["band", "value"]).select("band", "value", "class", "n", "pivot", "size"), "members")
        with_pivot = self.members.where(self._sized(F.col("n"), F.col("pivot.n"))).select(F.col("class").alias("a"), F.col("pivot.class").alias("b")).where("a <> b")
        pairs = settle(with_pivot.distinct(), "pivot-pairs")
        links = self._links(pairs)
        first = parts = settle(connected_components(links), "components")
        more = self._outside_links(parts)
        if more.take(1):
            parts = settle(connected_components(links.unionByName(more)), "components")
            forget(first)
        forget(pairs, links, more, self.pivots, self.members)
        self.facts = self.classes.select("class", "n").join(parts.withColumnRenamed("node", "class"), "class", "left").select("class", "n", F.coalesce("component", "class").alias("component"))

    def _sized(self, a, b):
        """Whether sets of these sizes can be similar enough."""
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)

    def _links(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` of classes that hold on their full sets, as forests."""
        side = lambda s: self.sketches.select(F.col("class").alias(s), F.col("sketch").alias(f"s{s}"))
        drawn = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")
        likely = settle(drawn.mapInArrow(plausible(self.least), "a binary, b binary"), "likely-pairs")
        texts = self._texts(likely.select(F.col("a").alias("class")).union(likely.select("b")))
        at = lambda s: texts.select(F.col("class").alias(s), F.col("text").alias(f"t{s}"))
        full = likely.join(at("a"), "a").join(at("b"), "b").select("a", "b", "ta", "tb")
        links = settle(full.mapInArrow(verified(self.shingle, self.percent), "a binary, b binary"), "links", PAIR_ROWS)
        forget(texts, likely)
        return links

    def _texts(self, classes: DataFrame) -> DataFrame:
        """``class, text``: a text of each class named."""
        needed = settle(classes.distinct().join(self.classes.select("class", "row"), "class").select("class", "row.r1", "row.r2"), "needed")
        texts = self.rows.select("r1", "r2", F.col(self.text_col).alias("text")).join(small_enough(needed, BROADCAST_ROWS) or needed, ["r1", "r2"])
        texts = settle(texts.groupBy("class").agg(F.first("text").alias("text")), "texts")
        forget(needed)
        return texts

    def _outside_links(self, parts: DataFrame) -> DataFrame:
        """Links ``a, b`` between members of one bucket of which at least one is outside the pivot's component."""
        of = parts.select(F.col("node").alias("class"), "component")
        placed = self.members.where("size > 2").join(of, "class", "left").withColumn("component", F.coalesce("component", "class"))
        placed = settle(placed, "placed")
        main = placed.where(F.col("class") == F.col("pivot.class")).select("band", "value", F.col("component").alias("main"))
        main = settle(main, "main")
        loose = placed.join(main, ["band", "value"]).withColumn("loose", F.col("component") != F.col("main"))
        loose = settle(loose.select("band", "value", "class", "n", "component", "loose", "pivot"), "loose")
        counts = loose.groupBy("band", "value").agg(F.sum(F.col("loose").cast("int")).alias("outs"), F.count(F.lit(1)).alias("all")).where("outs > 0")
        counts = counts.select("band", "value", F.ceil(F.col("outs") / CHUNK).cast("int").alias("hn"), F.ceil(F.col("all") / CHUNK).cast("int").alias("gn"))
        buckets = settle(counts, "open-buckets")
        # the pivot has met every member already
        met = loose.where(F.col("class") != F.col("pivot.class")).join(buckets, ["band", "value"]).drop("pivot")
        met = settle(met, "open-members")
        marks = self.classes.select("class", "sketch", "bands")
        both = met.withColumn("outside", F.explode(F.when(F.col("loose"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
        chunk = lambda n: F.pmod(F.xxhash64("class"), n).cast("int")
        both = both.join(marks, "class").withColumn("mine", F.when(F.col("outside"), chunk(F.col("hn"))).otherwise(chunk(F.col("gn"))))
        both = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("outside"), F.col("gn")).otherwise(F.col("hn")) - 1)))
        key = ["band", "value", "hi", "gi"]
        place = lambda here, there: F.when(F.col("outside"), F.col(here)).otherwise(F.col(there))
        units = both.select("band", "value", place("mine", "other").alias("hi"), place("other", "mine").alias("gi"), "class", "n", "component", "loose", "outside", "sketch", "bands")
        likely = settle(units.groupBy(*key).applyInArrow(likely_members(self.percent, self.least), MEMBER), "likely-members")
        texts = self._texts(likely.select("class"))
        full = likely.join(marks, "class").join(texts, "class")
        found = full.groupBy(*key).applyInArrow(outside_links(self.shingle, self.percent, self.least), "a binary, b binary")
        found = settle(found, "outside-links", PAIR_ROWS)
        forget(placed, main, loose, buckets, met, likely, texts)
        return found


def near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every document."""
    found = NearDuplicates(df.select(id_col, text_col), shingle, percent, [id_col, text_col], text_col)
    own = found.signed
    facts = settle(found.facts.select("class", "component"), "class-components")
    named = own.where("class is not null").groupBy("class").agg(F.min("__id").alias("least")).join(facts, "class")
    named = settle(named, "named-classes")
    least = settle(named.groupBy("component").agg(F.min("least").alias("component_id")), "least-ids")
    ids = settle(named.join(least, "component").select("class", "component_id"), "class-ids")
    forget(facts, named, least)
    out = own.join(ids, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("__id")).otherwise(F.col("component_id"))
    return out.select(F.col("__id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("__id").eqNullSafe(component).alias("kept"))


def without_near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, one of each component: that of the smallest id, ties by a hash of the row."""
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    id_, text = names[df.columns.index(id_col)], names[df.columns.index(text_col)]
    found = NearDuplicates(plain, shingle, percent, [id_, *[n for n in names if n != id_]], text)
    rank = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), "r1", "r2")
    best = found.signed.where("class is not null").groupBy("class").agg(F.min(rank).alias("best"))
    best = best.join(found.facts.select("class", "component"), "class").groupBy("component").agg(F.min("best").alias("best"))
    chosen = best.select("best.r1", "best.r2").unionByName(found.signed.where("class is null").select("r1", "r2").distinct().withColumn("none", F.lit(True)), allowMissingColumns=True)
    rows = found.rows.join(settle(chosen, "chosen"), ["r1", "r2"])
    # rows alike in every column are one component, unless they hold no words
    single = rows.where("none is null").dropDuplicates(["r1", "r2"])
    return single.unionByName(rows.where("none")).select(names).toDF(*df.columns)

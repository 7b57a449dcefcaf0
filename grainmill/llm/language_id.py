"""Language identification in two levels: family first, then pairs of languages within it.

A text is lower-cased, everything in ASCII that is no letter becomes a space, and its byte
2-grams and 3-grams are hashed into ``BUCKETS`` features, whose values are their shares.
One-against-rest linear support vector machines choose the language family; within a
family, one machine for each pair of languages votes, ties going to the larger margin.
All machines are trained here, by dual coordinate descent on a bounded sample.

Training rows: ``lang`` not null, and crc32 of the id as text not divisible by ``FOLDS``.
The sample takes about ``SAMPLE_PER_LANG`` rows of each language by a hash of the id, and
about ``SAMPLE_ROWS`` in all, whatever the table's size; their hashed features, not their
texts, go to the driver. If those are more than ``SAMPLE_FEATURES`` in all (8 bytes each),
the sample shrinks, alike for each language, until they fit; its texts stay whole. Prediction covers every row, on whole texts, and uses
nothing but the text.

Edge cases: a null text, or one without a letter, is ``und`` with score 0. With no
training row at all everything is ``und``. A null id counts as held out. Repeated rows
each get their row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.llm.arrow import bound_batches, map_texts, release, slices
from grainmill.runtime import forget, settle

BUCKETS = 1 << 16
#: Gram starts measured at a time; each takes some 40 bytes of working memory.
PART_STARTS = 1 << 18
FOLDS = 5
SAMPLE_PER_LANG, SAMPLE_ROWS, SAMPLE_FEATURES = 1200, 12_000, 6_000_000
#: Parts of the sample by whose features it is cut; a row for each goes to the driver.
DRAWS = 1024
#: Rows of a batch while texts are measured or filtered.
TEXT_ROWS = 2000
UNKNOWN = "und"

#: Family of each language code. Other codes form a family of their own.
FAMILIES = {
    "germanic": "af da de en fo is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "baltic": "lt lv",
    "turkic": "az kk ky tr uz",
    "indic": "bn gu hi mr ne pa si ur",
    "semitic": "ar he mt",
    "sinitic": "yue zh",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = regex.compile(r"\p{L}")
#: ASCII without letters becomes a space; bytes of other characters stay.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 2-grams and 3-grams starting at each byte but the last two."""
    b = data.astype(np.uint32)
    two = (b[:-2] << 8) | b[1:-1]
    three = (two << 8) | b[2:]
    mix = lambda x: (x * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return mix(two), mix(three + np.uint32(0x5BD1E995))


def prepared(text: str) -> bytes:
    return b" " + text.lower().encode().translate(_TABLE) + b"  "


def pieces(text: str) -> Iterator[bytes]:
    """The prepared text in parts of bounded size, that overlap so that each gram starts in one of them."""
    data = prepared(text)
    for start in range(0, len(data) - 2, PART_STARTS):
        yield data[start : start + PART_STARTS + 2]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features."""
    counts, total = np.zeros(BUCKETS, np.int64), 0
    for piece in pieces(text):
        for found in grams(np.frombuffer(piece, np.uint8)):
            counts += np.bincount(found, minlength=BUCKETS)
            total += len(found)
    at = np.flatnonzero(counts)
    return at, counts[at] / total


def train_svm(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 50.0, epochs: int = 12) -> np.ndarray:
    """Weights, the bias last, of a linear machine with squared hinge loss."""
    w, rng = np.zeros(BUCKETS + 1), np.random.default_rng(7)
    alpha, diag = np.zeros(len(rows)), 0.5 / cost
    norms = np.array([float(v @ v) + 1e-4 for _, v in rows])
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            g = y[i] * (w[at] @ v + w[-1] * 1e-2) - 1 + diag * alpha[i]
            new = max(alpha[i] - g / (norms[i] + diag), 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * v
                w[-1] += step * 1e-2
                alpha[i] = new
    w[-1] *= 1e-2
    return w


@dataclass
class Model:
    """Weights of all machines, a column each, and what each decides."""

    weights: np.ndarray  # BUCKETS + 1 rows
    families: list[str]  # the first columns, if more than one
    pairs: list[tuple[str, str]]  # the columns after them; positive means the first
    members: dict[str, list[str]] = field(default_factory=dict)

    def decide(self, margins: np.ndarray) -> tuple[str, float]:
        """Language and score of a row of margins."""
        start = len(self.families) if len(self.families) > 1 else 0
        best, score = 0, 1.0
        if start:
            order = np.argsort(-margins[:start], kind="stable")
            best = int(order[0])
            score = _logistic(margins[best] - margins[order[1]])
        langs = self.members[self.families[best]]
        votes = {lang: [0, 0.0] for lang in langs}
        for k, (a, b) in enumerate(self.pairs, start):
            if a in votes and b in votes:
                m = float(margins[k])
                votes[a if m >= 0 else b][0] += 1
                votes[a][1] += m
                votes[b][1] -= m
        winner = max(langs, key=lambda lang: (votes[lang][0], votes[lang][1]))
        against = [m if a == winner else -m for k, (a, b) in enumerate(self.pairs, start) if winner in (a, b) for m in [float(margins[k])]]
        return winner, score * (_logistic(2 * min(against)) if against else 1.0)

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.members:
            return langs, scores
        sums, starts = np.zeros((len(texts), self.weights.shape[1])), np.zeros(len(texts), np.int64)
        waiting: list[tuple[int, bytes]] = []
        room = PART_STARTS
        for i, value in enumerate(texts):
            text = value.as_py()
            if not text or not _LETTER.search(text):
                continue
            for piece in pieces(text):
                if len(piece) > room and waiting:
                    self._measure(waiting, sums, starts)
                    waiting, room = [], PART_STARTS
                waiting.append((i, piece))
                room -= len(piece)
        if waiting:
            self._measure(waiting, sums, starts)
        for i in np.flatnonzero(starts).tolist():
            langs[i], scores[i] = self.decide(sums[i] / (2 * starts[i]) + self.weights[BUCKETS])
        return langs, scores

    def _measure(self, parts: list[tuple[int, bytes]], sums: np.ndarray, starts: np.ndarray) -> None:
        """Adds to each text's sums of weights and number of gram starts those of its pieces."""
        of = np.array([i for i, _ in parts])
        sizes = np.array([len(p) for _, p in parts])
        ends = np.cumsum(sizes)
        two, three = grams(np.frombuffer(b"".join(p for _, p in parts), np.uint8))
        # the last two starts of a piece also see the next one's first bytes: leave them out
        bounds = np.stack([ends - sizes, ends - 2], 1).ravel()[:-1]
        np.add.at(starts, of, sizes - 2)
        for k in range(self.weights.shape[1]):
            w = np.ascontiguousarray(self.weights[:BUCKETS, k])
            np.add.at(sums[:, k], of, np.add.reduceat(w[two] + w[three], bounds)[::2])


def _logistic(x: float) -> float:
    return 1 / (1 + float(np.exp(-min(max(x, -30), 30))))


def held_out(id_col: str) -> Column:
    """Whether a row is kept away from training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")), F.lit(0)) % FOLDS == 0


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from a bounded sample of the labelled rows that are not held out."""
    try:
        return _train(df, id_col, text_col, lang_col)
    finally:
        release()  # the driver goes on without the sample


def _train(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> Model:
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # a row for each language
    if not counts:
        return Model(np.zeros((BUCKETS + 1, 0)), [], [])
    each = min(SAMPLE_PER_LANG, SAMPLE_ROWS // len(counts))
    draw = F.pmod(F.xxhash64(F.lit("language sample"), F.col(id_col).cast("string")), F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    # a row's draw as a part of its language's share
    part = F.floor(draw / share[F.col(lang_col)] * DRAWS).cast("int")
    sample = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), part.alias("part")).where(F.col("part") < DRAWS)

    def measured(texts: pa.Array) -> dict:
        found = [features(t) for t in texts.to_pylist()]
        return {"at": [a.astype(np.int32) for a, _ in found], "value": [v.astype(np.float32) for _, v in found]}

    fields = [T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.FloatType()))]
    drawn = settle(map_texts(sample, ["id", "lang", "part"], "text", measured, fields), "language-sample", TEXT_ROWS)
    stop, room = DRAWS, SAMPLE_FEATURES
    for r in sorted(drawn.groupBy("part").agg(F.sum(F.size("at")).alias("n")).collect()):  # DRAWS rows at most
        room -= r.n
        if room < 0:
            stop = r.part
            break
    got = drawn.where(F.col("part") < stop).select("id", "lang", "at", "value").toArrow()
    forget(drawn)
    if not got.num_rows:
        return Model(np.zeros((BUCKETS + 1, 0)), [], [])
    order = np.argsort(np.array([str(x) for x in got.column("id").to_pylist()]), kind="stable")
    lang = np.array(got.column("lang").to_pylist(), dtype=object)[order]
    at, value = got.column("at").combine_chunks(), got.column("value").combine_chunks()
    # shares are small: bring margins to about one
    rows_ = [(at[int(i)].values.to_numpy(), value[int(i)].values.to_numpy().astype(float) * 30) for i in order]

    langs = sorted(set(lang))
    family = {x: FAMILY.get(x.split("-")[0], f"other {x}") for x in langs}
    families = sorted(set(family.values()))
    members = {f: [x for x in langs if family[x] == f] for f in families}
    columns = []
    if len(families) > 1:
        own = np.array([family[x] for x in lang], dtype=object)
        columns += [train_svm(rows_, np.where(own == f, 1.0, -1.0)) for f in families]
    pairs = [(a, b) for f in families for i, a in enumerate(members[f]) for b in members[f][i + 1 :]]
    for a, b in pairs:
        pick = [i for i, x in enumerate(lang) if x in (a, b)]
        columns.append(train_svm([rows_[i] for i in pick], np.where(lang[pick] == a, 1.0, -1.0)))
    weights = np.stack(columns, 1) if columns else np.zeros((BUCKETS + 1, 0))
    weights[:BUCKETS] *= 30
    return Model(weights, families, pairs, members)


PREDICTION = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


def _predictor(df: DataFrame, model: Model):
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, a column for each machine

    def predict(texts: pa.Array) -> dict:
        langs, scores = shared.value.predict(texts)
        return {"lang_pred": langs, "score": scores}

    return predict


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, lang_pred, score`` of every whole text; no shuffle."""
    rows = df.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col))
    return map_texts(rows, [id_col, "held_out"], text_col, _predictor(df, model), PREDICTION)


def accept(df: DataFrame, model: Model, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is in a known language with at least that score.

    Rows pass through Python in bounded batches and are filtered there: that costs no shuffle of texts.
    """
    own = df.columns
    inner = df.toDF(*[f"c{i}" for i in range(len(own))])
    at, shared = own.index(text_col), df.sparkSession.sparkContext.broadcast(model)

    def kept(batches):
        for batch in batches:
            for part in slices(batch, at):
                langs, scores = shared.value.predict(part.column(at))
                fit = [lang != UNKNOWN and score >= least_score for lang, score in zip(langs, scores)]
                yield part if all(fit) else part.filter(pa.array(fit, pa.bool_()))
                del part
            release()

    bound_batches(df.sparkSession)
    return settle(inner.mapInArrow(kept, inner.schema), "accepted", TEXT_ROWS).toDF(*own)

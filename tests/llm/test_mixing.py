import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from grainmill.llm.mixing import Mix, golden_step, mix, mixed_rows, targets


def test_targets_are_capped_and_share_everything():
    got = targets([10, 10, 80], [1, 2, 3], 3)
    assert abs(sum(got) - 100) < 1e-9 and got[1] == 30 and all(t <= 3 * s + 1e-9 for t, s in zip(got, [10, 10, 80]))
    assert targets([0, 5], [1, 2], 3) == [0.0, 5.0] and targets([], [], 3) == [] and targets([0], [1], 3) == [0.0]


def test_every_source_comes_near_its_target_and_no_document_exceeds_three_passes(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = mix(docs).collect()
    assert len(rows) == docs.count() and sorted(mix(docs.repartition(7)).collect()) == sorted(rows)
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    taken, size, want = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        size[source[r.doc_id]] += r.size
        want[source[r.doc_id]] = (r.target, r.source_size)
    names = sorted(size)
    ts = targets([size[n] for n in names], [1.0 + i % 3 for i in range(len(names))], 3)
    for n, t in zip(names, ts):
        assert want[n] == (t, size[n]) and abs(taken[n] - t) <= 1


def test_taken_equals_brute_force(spark, small):
    """Each source's documents in order of the hash, over and over, until the words of its target are out."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.select("doc_id", "text", "source", F.xxhash64(F.lit("mix"), "doc_id", "text").alias("h")).collect()
    size = {r.doc_id: len(re.findall("[^ \t-\r]+", r.text or "")) for r in rows}
    names = sorted({r.source for r in rows if r.source is not None}) + [None] * any(r.source is None for r in rows)
    of = {n: [r for r in rows if r.source == n] for n in names}
    whole = {n: sum(size[r.doc_id] for r in of[n]) for n in names}
    low, high, total = 0.0, 1e12, sum(whole.values())
    for _ in range(200):
        level = (low + high) / 2
        goal = {n: min(level * (1 + i % 3), 3 * whole[n]) for i, n in enumerate(names)}
        low, high = (level, high) if sum(goal.values()) < total else (low, level)
    want = Counter({r.doc_id: 0 for r in rows})
    for n in names:
        left = min(round(goal[n]), 3 * whole[n])
        order = sorted(of[n], key=lambda r: (r.h % (1 << 64), r.doc_id))
        while left:
            for r in order:
                part = min(left, size[r.doc_id])
                want[r.doc_id] += part
                left -= part
    got = {r.doc_id: r.taken for r in mix(docs, block_words=777).collect()}
    off = [i for i in want if abs(got[i] - want[i]) > 0]
    assert len(got) == len(rows) and len(off) <= len(names) and all(abs(got[i] - want[i]) <= 1 for i in off)  # a target may round either way


def test_schedule_is_a_permutation_with_low_discrepancy(spark, small):
    m = Mix(spark.read.parquet(f"{small}/documents.parquet"), block_words=500)
    slots = sorted(m.schedule().collect())
    assert [s.position for s in slots] == list(range(m.total)) and m.total > 500
    ranks, share = defaultdict(list), {r["__s"]: r["__slots"] / m.total for r in m.sources.collect()}
    for s in slots:
        ranks[s["__s"]].append(s["rank"])
        assert all(abs(len(ranks[k]) - v * (s.position + 1)) < 4 for k, v in share.items())
    assert all(v == list(range(len(v))) for v in ranks.values())
    lengths = defaultdict(int)
    for r in m.segments().select("position", "length").collect():
        lengths[r.position] += r.length
    full = [n for n in lengths.values() if n == 500]
    assert len(lengths) == m.total and len(full) >= m.total - len(share) and max(lengths.values()) == 500
    assert all(math.gcd(golden_step(n), n) == 1 for n in range(1, 200))


def test_odd_rows(spark):
    rows = spark.createDataFrame(
        [(1, "a b", "x", 1), (1, "a b", "x", 1), (None, "c " * 5000, None, 1), (2, None, "x", 1), (3, "", "é", 1), (4, "w", "é", 1)],
        "doc_id long, text string, source string, size int",
    )
    got = mix(rows, block_words=7).collect()
    assert len(got) == 6 and sum(r.taken for r in got) > 0
    by = sorted((r.doc_id or 0, r.size, r.source_size) for r in got)
    assert by == [(0, 5000, 5000), (1, 2, 4), (1, 2, 4), (2, 0, 4), (3, 0, 1), (4, 1, 1)]
    assert mix(rows.limit(0)).count() == 0
    copies = mixed_rows(rows)
    assert copies.columns == rows.columns and copies.where("doc_id = 1").count() == 6 and copies.where("size(split(text, ' ')) > 4000").count() == 1

import random
import re

import numpy as np
import pytest

from grainmill.llm import minhash
from grainmill.llm.minhash import near_duplicates, shingle_sets, superminhash, without_near_duplicates
from grainmill.llm.oracles import ORACLES
from grainmill.llm.queries import QUERIES
from tests.oracle import assert_same


def test_query_equals_its_sql(spark, small):
    assert_same(QUERIES["op1_minhash_near_dedup"](spark, small), ORACLES["op1_minhash_near_dedup"], small)


def sets(text, size):
    w = re.findall("[^ \t-\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, size, percent):
    s, root = [sets(t, size) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), d)
    return sorted(str((d, len(s[i]), least.get(find(i)) if s[i] else d)) for i, (d, _) in enumerate(rows))


def chain(rng, steps, n=120):
    """Texts of which each is like the next, and not like those farther on."""
    words, out = [f"w{rng.randrange(10**6)}" for _ in range(n)], []
    for _ in range(steps):
        out.append(" ".join(words))
        for _ in range(3):
            words[rng.randrange(n)] = f"w{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("size,chunk", [(2, 256), (5, 4), (2, 3)])
def test_equals_brute_force_on_chains_crowds_and_odd_rows(spark, monkeypatch, size, chunk):
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    rng = random.Random(size * chunk)
    texts = chain(rng, 25) + chain(rng, 12, 40)
    base = texts[0].split()
    for _ in range(40):  # a crowd of near copies of one text
        w = list(base)
        for _ in range(rng.randrange(7)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += ["One  word\n", "one word", "one", " ONE\t", "", None, None, "  ", "é É", "a b c " * 3000, "a b c " * 2999 + "d", "a b\x0bc"] + [texts[3]] * 30
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[3]), (None, "alone here"), (None, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    got = near_duplicates(df, size, 80).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute(rows, size, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    left = without_near_duplicates(df, size, 80)
    assert left.columns == df.columns
    comps = [r for r in brute(rows, size, 80) if not r.split(", ")[1] == "0"]
    roots = {r.split(", ")[2] for r in comps}
    assert left.count() == len(roots) + sum(1 for _, t in rows if not (t or "").split())
    assert near_duplicates(df.limit(0), size, 80).count() == 0 and without_near_duplicates(df.limit(0), size, 80).count() == 0


def test_signatures_estimate_similarity_and_early_stop_changes_nothing():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    errors = []
    for k in (8, 60, 900):
        for _ in range(30):
            a = np.unique(rng.choice(pool, k))
            b = np.unique(np.concatenate([a[: int(len(a) * 0.9)], rng.choice(pool, max(1, k // 10))]))
            h = superminhash([a, b])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append((h[0] == h[1]).mean() - true)
            assert (superminhash([a])[0] == h[0]).all()
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_shingle_hashes_tell_windows_apart():
    import pyarrow as pa

    got = shingle_sets(pa.array(["a b c", "A b", "b c", "c b", "x", None, "ab c"]), 2)
    assert [len(g) for g in got] == [2, 1, 1, 1, 1, 0, 1]
    assert set(got[0]) == {got[1][0], got[2][0]} and len({int(g[0]) for g in got if len(g)} | {int(got[0][1])}) == 5


def test_a_pair_is_verified_in_the_first_bucket_it_shares_whatever_its_sketches_say():
    """The sketches are equal in an earlier band by chance; the pair meets in band 2 alone."""
    import pyarrow as pa

    text = "a b c d e f g h"
    bands = [[k * 100 + x for k in range(minhash.BANDS)] for x in (0, 1)]
    bands[1][2] = bands[0][2]

    def unit(band):
        rows = [(True, True, b"x", b"x", 0), (False, True, b"y", b"y", 1), (False, True, b"x", b"x", 0)]
        return pa.table(
            {
                "band": pa.array([band] * 3, pa.int32()), "outside": [r[0] for r in rows], "loose": [r[1] for r in rows], "n": pa.array([7] * 3, pa.int64()),
                "class": pa.array([r[2] for r in rows], pa.binary()), "component": pa.array([r[3] for r in rows], pa.binary()),
                "sketch": pa.array([bytes(minhash.PLACES)] * 3, pa.binary()), "bands": pa.array([bands[r[4]] for r in rows], pa.list_(pa.int64())), "text": [text] * 3,
            }
        )

    run = minhash.outside_links(2, 80, minhash.least_matches(80))
    assert run(unit(2)).to_pylist() == [{"a": b"x", "b": b"y"}]
    assert run(unit(0)).num_rows == 0

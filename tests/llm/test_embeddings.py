import math

import numpy as np
import pytest

from grainmill.llm import embeddings
from grainmill.llm.embeddings import near_duplicates
from grainmill.llm.oracles import ORACLES
from grainmill.llm.queries import QUERIES
from tests.oracle import assert_same


def test_query_equals_its_sql(spark, small):
    assert_same(QUERIES["op10_embedding_near_dedup"](spark, small), ORACLES["op10_embedding_near_dedup"], small)


def brute(rows, cosine):
    def ok(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    x = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok(v, lab) else None for _, v, lab in rows]
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and float(x[i] @ x[j]) >= cosine:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), rows[i][0])
    return sorted(str((rows[i][0], links[i], least.get(find(i)) if x[i] is not None else rows[i][0])) for i in range(n))


@pytest.mark.parametrize("chunk,dim", [(1024, 5), (7, 40), (9, 3), (5, 1)])
def test_equals_brute_force_with_crowds_and_odd_rows(spark, monkeypatch, chunk, dim):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    rows = [(i, rng.standard_normal(dim).astype("f4").tolist(), int(i % 2)) for i in range(60)]
    for k in range(60):  # a crowd whose members are near its centre, not all near each other
        rows.append((100 + k, (np.array(rows[0][1]) + 0.25 * rng.standard_normal(dim)).astype("f4").tolist(), 0))
    rows += [(200 + k, rows[3][1], 1) for k in range(30)] + [(3, rows[3][1], 1), (None, rows[3][1], 1)]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * dim, 1), (303, [float("nan")] + [1.0] * (dim - 1), 1), (304, [None] + [1.0] * (dim - 1), 1)]
    rows += [(305, rows[3][1], None), (306, [float("inf")] + [1.0] * (dim - 1), 1), (307, [1e38] * dim, 0), (308, [1e-38] * dim, 0), (309, [1.0] * (dim + 1), 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, kept string")
    got = near_duplicates(df, 0.9).collect()
    assert sorted(str((r.vec_id, r.n_links, r.component_id)) for r in got) == brute(rows, 0.9)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0

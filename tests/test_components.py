import random

import pytest

from grainmill.operators.components import connected_components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(5, 5), (None, 3), (1000, 1001), (1001, 1000)]
    edges += [(i, i + 1) for i in range(2000, 2040)] + [(3000, 3001 + i) for i in range(500)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.component for r in got} == brute(edges)


def test_strings_and_empty(spark):
    frame = spark.createDataFrame([("x", "b"), ("b", "a")], "a string, b string")
    assert {r.node: r.component for r in connected_components(frame).collect()} == {"x": "a", "b": "a", "a": "a"}
    assert connected_components(frame.limit(0)).count() == 0

import random
from collections import defaultdict

from chainlens.llm.graph import connected_components


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent[root(a)] = root(b)
    out = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want, got = defaultdict(set), defaultdict(set)
    for x in {x for e in edges for x in e}:
        want[root(x)].add(x)
        got[out[x]].add(x)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))
    assert all(label in nodes for label, nodes in got.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0

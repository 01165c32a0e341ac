import random

from matchlake.llm.components import components


def by_hand(edges):
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and b is not None:
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
    return {x: top(x) for x in root if top(x) != x}


def test_components(spark):
    rng = random.Random(2)
    chain = [(k, k + 1) for k in range(60)]
    star = [(1000, k) for k in range(1001, 1200)]
    loose = [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(150)]
    for edges in (chain, star, loose + chain + star + [(5, 5), (None, 1)], [], [(7, 7)]):
        table = spark.createDataFrame(edges, "a long, b long")
        assert {r.node: r.root for r in components(table).collect()} == by_hand(edges)

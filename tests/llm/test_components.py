import random

from strata.llm.components import connected_components


def smallest(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def check(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    got = [(r["node"], r["component"]) for r in connected_components(df).collect()]
    real = [(u, v) for u, v in edges if u is not None and v is not None and u != v]
    assert len(got) == len(dict(got))
    assert dict(got) == smallest(real)


def test_long_chain_star_and_random_graph(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, i) for i in range(1001, 1400)]
    loose = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)]
    check(spark, chain[::-1] + star + loose + loose[:20])


def test_no_links_self_links_and_nulls(spark):
    check(spark, [(5, 5), (None, 3), (4, None)])
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0

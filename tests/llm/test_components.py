import random

from corpusloom.llm.components import components


def test_roots_are_the_smallest_reachable(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)] + [(300, 300), (5, 4), (5, 4)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long"), "test").collect()}
    want = {x: find(x) for a, b in links if a != b for x in (a, b)}
    assert got == want


def test_no_links(spark):
    assert components(spark.createDataFrame([(1, 1)], "u long, v long"), "test").count() == 0

import random

from riskframe.llm.components import connected_components


def test_components_of_paths_stars_and_noise(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(501, 560)] + [(900, 900), (7, 7), (None, 3), (3, None)]
    edges += [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(70)]
    r.shuffle(edges)
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0

import math
import random

import pytest

from riskframe.llm import embedding_join as E


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def brute(rows, limit=0.93):
    def sound(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (_, v, p) in enumerate(rows):
        for b, (_, w, q) in enumerate(rows[:a]):
            if p == q and sound(v, p) and sound(w, q) and len(v) == len(w):
                dot = sum(x * y for x, y in zip(v, w))
                if dot / math.sqrt(sum(x * x for x in v) * sum(y * y for y in w)) >= limit:
                    links[a] += 1
                    links[b] += 1
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {i: (links[i], find(i)) for i in range(len(rows))}


def vectors(seed, n=220, dims=6):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(8)]
    rows = []
    for i in range(n):
        c = r.choice(centres)
        rows.append((i, [x + r.gauss(0, 0.2) for x in c], 1 if r.random() < 0.6 else r.choice([2, 3, None])))
    odd = [None, [], [0.0] * dims, [float("nan")] * dims, [None, *[1.0] * (dims - 1)], [float("inf")] * dims, [1.0, 2.0], [1.0, 2.0], [1e-30] * dims, [3e30] * dims, [1.0] * dims]
    rows += [(n + k, v, 1) for k, v in enumerate(odd)]
    return rows + [(len(rows) + k, rows[0][1], rows[0][2]) for k in range(30)]


@pytest.mark.parametrize("tile,pivots", [(1024, 4096), (16, 4096), (16, 3)])
def test_equals_all_pairs(spark, tile, pivots):
    rows = vectors(tile)
    rows = [(i, v and [x if x is None else struct_float(x) for x in v], p) for i, v, p in rows]
    got = {r["vec_id"]: r for r in E.near_duplicates(table(spark, rows), tile_rows=tile, max_pivots=pivots).collect()}
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == brute(rows)
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def struct_float(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_missing_and_repeated_ids_and_an_empty_table(spark):
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.01], 1), (9, [0.0, 1.0], 1)]
    out = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in E.near_duplicates(table(spark, rows)).collect())
    assert out == [("5", 2, 5, True), ("5", 2, 5, True), ("9", 0, 9, True), ("None", 2, None, True)]
    assert E.near_duplicates(table(spark, [])).count() == 0
    clash = table(spark, [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)]).selectExpr("*", "1 AS id", "2 AS n_links")
    kept = E.keep_one_of_each(clash)
    assert kept.columns == clash.columns and [r["vec_id"] for r in kept.collect()] == [1]

import random
import zlib

import numpy as np
import pytest

from riskframe.llm import quality as Q
from riskframe.llm import queries
from tests.llm.helpers import by_id, docs_table

SF = "/root/testdata/sf0.01"


def test_chunks_cover_every_byte():
    for n in (0, 1, Q.CHUNK - 1, Q.CHUNK, Q.CHUNK + 1, 5000):
        chunks = Q.chunk_bytes(np.arange(n) % 251)
        step = Q.CHUNK - Q.OVERLAP
        back = np.full(len(chunks) * step + Q.OVERLAP, Q.PAD)
        for i, c in enumerate(chunks):
            back[i * step : i * step + Q.CHUNK] = c
        assert (back[:n] == np.arange(n) % 251).all() and (back[n:] == Q.PAD).all()


def test_gradients_equal_differences():
    net = Q.ByteNet()
    for name in net.NAMES:
        setattr(net, name, getattr(net, name).astype(np.float64))
    r = np.random.default_rng(0)
    texts = [r.integers(0, 256, n).astype(np.uint8) for n in (30, 700, 1200)]
    y, w = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        p = net.probabilities(texts)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum() / 3

    grads = Q._gradients(net, texts, y, w)
    for name in ("filters", "w1", "w2", "mix", "b2"):
        flat, at = getattr(net, name).reshape(-1), int(np.abs(grads[name]).argmax())
        old, h = flat[at], 1e-3
        flat[at] = old + h
        up = loss()
        flat[at] = old - h
        down = loss()
        flat[at] = old
        assert abs((up - down) / (2 * h) - grads[name].reshape(-1)[at]) < 2e-2 * max(0.05, abs(grads[name]).max())


def test_held_out_accuracy(spark):
    scored = by_id(queries.op5_quality(spark, SF))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, row in scored.items():
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= row["score"] <= 1
        assert row["predicted"] == int(row["score"] >= 0.3)
    rest = [(scored[i]["score"], q) for i, q in labels.items() if scored[i]["held_out"]]
    good, bad = [s for s, q in rest if q], [s for s, q in rest if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_the_score_depends_on_the_whole_text(spark):
    r = random.Random(0)
    fine = lambda n: " ".join("".join(r.choice("etaoins") for _ in range(5)) for _ in range(n))
    junk = lambda n: " ".join("###$$$%%%" for _ in range(n))
    texts, labels = [], []
    for i in range(160):
        bad = i % 2
        texts.append(fine(60 + i) + " " + (junk(40) if bad else fine(40)))
        labels.append(1 - bad)
    net = Q.train([t.encode() for t in texts], labels, rounds=12)
    docs = docs_table(spark, [fine(3000), fine(3000) + " " + junk(100), None, ""]).withColumnRenamed("lang", "score")
    got = by_id(Q.score_quality(docs, net, output="p"))
    assert got[0]["p"] > 0.5 > got[1]["p"] and got[2]["p"] == got[3]["p"]
    assert Q.keep_good(docs, net).columns == docs.columns


@pytest.mark.parametrize("labels,want", [([], 0.5), ([1, 1], 1.0), ([0], 0.0)])
def test_without_two_classes(spark, labels, want):
    docs = docs_table(spark, ["abc"] * len(labels) + ["x"], [*range(1, len(labels) + 1), 99])
    table = spark.createDataFrame([(i + 1, q, None) for i, q in enumerate(labels)], "doc_id long, quality int, toxic int")
    net = Q.fit_quality(docs, table)
    assert {r["s"] for r in Q.score_quality(docs, net, output="s").collect()} == {want}
    assert Q.score_quality(docs_table(spark, []), net).count() == 0

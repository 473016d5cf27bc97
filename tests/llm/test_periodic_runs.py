import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.llm import periodic_runs, queries
from tests.conftest import DATA
from tests.llm.helpers import by_id, docs_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, shortest=6, exponent=4):
    """Every maximal stretch of each period, by looking at all places; the least period of a stretch is looked for anew."""
    found, n = set(), len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(shortest, exponent * q):
                part = words[i : i + length]
                if not any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(words):
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return {
        "n_runs": len(runs),
        "start": best and best[0],
        "length": best and best[1],
        "period": best and best[2],
        "exponent_milli": best and 1000 * best[1] // best[2],
        "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    }


def found(texts, **least):
    text, *columns = periodic_runs.runs_of_words([[w.encode() for w in t] for t in texts], **least)
    out = [[] for _ in texts]
    for t, *run in zip(text.tolist(), *[c.tolist() for c in columns]):
        out[t].append(tuple(run))
    return out


REPEATS = st.lists(st.tuples(st.text("ab", min_size=1, max_size=5), st.integers(1, 9)), max_size=8)


@settings(max_examples=300, deadline=None)
@given(st.lists(REPEATS.map(lambda parts: "".join(p * n for p, n in parts)), max_size=6), st.sampled_from([(6, 4), (2, 2), (7, 3)]))
def test_equals_brute_force(texts, least):
    shortest, exponent = least
    assert found(texts, shortest=shortest, exponent=exponent) == [brute_runs(list(t), shortest, exponent) for t in texts]


def test_extensions_equal_comparing_words():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(40)) * 12, "a" * 700, "abcab" * 90 + "x" + "abcab" * 90, "b"]
    texts += texts  # whole texts repeat, so order is decided far behind
    x = np.array([c for i, t in enumerate(texts) for c in [*(1 + ord(c) - 97 for c in t), 100 + i]], np.int64)
    lce = periodic_runs.Extensions(x)
    first = np.cumsum([0, *[len(t) + 1 for t in texts]])
    a, b = [], []
    for _ in range(4000):
        t = rng.randrange(len(texts))
        if len(texts[t]) > 1:
            i, j = sorted(rng.sample(range(len(texts[t])), 2))
            a.append(int(first[t]) + i)
            b.append(int(first[t]) + j)
    want = []
    for i, j in zip(a, b):
        k = 0
        while x[i + k] == x[j + k]:
            k += 1
        want.append(k)
    assert lce.ask(np.array(a), np.array(b)).tolist() == want


def test_every_two_residues_reach_the_cover():
    assert periodic_runs._STEPS.min() >= 0 and periodic_runs._STEPS.max() < periodic_runs.MODULUS


def test_small_slices_change_nothing(monkeypatch):
    texts = ["abab" * 30, "a" * 50, "xyz" * 4 + "q" * 8]
    whole = found(texts)
    monkeypatch.setattr(periodic_runs, "TOGETHER", 5)
    assert found(texts) == whole == [brute_runs(list(t)) for t in texts]


def test_a_long_text_of_one_word_and_a_long_period():
    assert found([["a"] * 100_000]) == [[(0, 100_000, 1)]]
    words = [str(i) for i in range(9_999)]
    assert found([["x", *(words * 5)]]) == [[(1, 49_995, 9_999)]]


TEXTS = [
    "a a a a a a", "a a a a a", "", None, " \t\n\x0b\x0c\r ", "a b\ta b\x0ba b\x0ca b c", "a b a b a b a", "é x " * 4, "a\xa0a " * 7,
    "x y z " * 200_000, "q w a a a a a a q w a a a a a a q w a a a a a a q w a a a a a a", "same same same same same same",
    "same same same same same same",
]


@pytest.mark.parametrize("unit", [1, 200_000])
def test_runs_of_a_table(spark, monkeypatch, unit):
    monkeypatch.setattr(periodic_runs, "UNIT_WORDS", unit)
    got = by_id(periodic_runs.find_runs(docs_table(spark, TEXTS)).withColumn("best", periodic_runs.most_repeated()))
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        words = WORD.findall(text or "")
        runs = brute_runs(words) if len(words) < 1000 else [(0, 600_000, 3)]
        assert [tuple(r) for r in got[i]["runs"]] == runs
        assert got[i]["n_words"] == len(words)
    assert got[9]["collapsed"] == "x y z"
    assert got[3]["collapsed"] == "" and got[3]["best"] is None
    assert tuple(got[10]["best"]) == (2, 6, 1)


def test_best_run_is_exact_and_ties_go_to_the_first(spark):
    runs = [(0, 41, 10), (50, 6, 1), (60, 12, 2), (90, 6_000_000_007, 1_000_000_001), (91, 4, 1)]
    rows = spark.createDataFrame([(runs,)], periodic_runs.T.StructType().add("runs", periodic_runs.T.ArrayType(periodic_runs.RUN)))
    assert tuple(rows.select(periodic_runs.most_repeated().alias("r")).first()["r"]) == (90, 6_000_000_007, 1_000_000_001)
    rows = rows.select(F.slice("runs", 1, 3).alias("runs"))
    assert tuple(rows.select(periodic_runs.most_repeated().alias("r")).first()["r"]) == (50, 6, 1)


def test_repeated_and_missing_ids_empty_table_and_other_columns(spark):
    docs = docs_table(spark, ["a a a a a a", "a a a a a a", "c", None], [7, 7, None, None])
    docs = docs.withColumnRenamed("lang", "row").withColumnRenamed("source", "runs").withColumnRenamed("n_chars", "a`b.c")
    rows = periodic_runs.find_runs(docs, keep=("doc_id", "row", "a`b.c")).collect()
    assert sorted((r["doc_id"] or 0, len(r["runs"]), r["a`b.c"] or 0) for r in rows) == [(0, 0, 0), (0, 0, 1), (7, 1, 11), (7, 1, 11)]
    assert periodic_runs.find_runs(docs_table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, exponent=1)


def test_query_equals_brute_force(spark):
    got = by_id(queries.op12_periodic_runs(spark, DATA))
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(rows)
    assert any(zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows)
    for r in rows:
        want = expected(planted(WORD.findall(r["text"] or ""), r["doc_id"]))
        assert {k: got[r["doc_id"]][k] for k in want} == want, r["doc_id"]

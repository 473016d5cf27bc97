import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskframe.llm import decontaminate as D
from tests.llm.helpers import by_id, docs_table, split_words

LONG = " ".join(f"Word{i}" for i in range(20))
ITEMS = [(1, LONG), (2, "short ítem, here"), (3, None), (4, "..."), (1, LONG), (None, "secret phrase without id"), (10, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12")]


def bench(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


def brute(texts, items, size=13):
    windows = {}
    for item, text in items:
        w = split_words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).update([] if item is None else [str(item)])
    out = []
    for text in texts:
        w = split_words(text)
        hit, owners = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    owners |= windows[tuple(w[i : i + n])]
        out.append((len(w), len(hit), sorted(owners)))
    return out


TEXTS = [
    "x " + LONG.upper() + "! y", LONG[: len(LONG) // 2], "a SHORT  ítem\there; secret phrase, without id", None, "", "!!!",
    "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11", "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w0", "filler " * 400_000 + LONG,
    "short ítem", "x " + LONG.upper() + "! y", "short ítem here " * 3,
]


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 60])
def test_marks_equal_brute_force(spark, block_bytes):
    got = by_id(D.mark_contamination(docs_table(spark, TEXTS), bench(spark), block_bytes=block_bytes))
    marks = [(m["n_words"], m["n_hit"], m["items"]) for m in (got[i]["marks"] for i in range(len(TEXTS)))]
    assert marks == brute(TEXTS, ITEMS)


def test_dropping_and_cutting(spark):
    docs = docs_table(spark, TEXTS).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "marks")
    kept = by_id(D.drop_contaminated(docs, bench(spark)))
    want = {i for i, (n, h, _) in enumerate(brute(TEXTS, ITEMS)) if not (h and 20 * h >= n)}
    assert set(kept) == want and kept[3]["text"] is None
    cut = by_id(D.remove_spans(docs, bench(spark)))
    assert cut[0]["text"] == "x ! y" and cut[3]["text"] is None and cut[9]["text"] == "short ítem"
    assert cut[8]["text"] == "filler " * 400_000


def test_empty_tables(spark):
    assert by_id(D.mark_contamination(docs_table(spark, ["a"]), bench(spark, [])))[0]["marks"]["n_hit"] == 0
    assert D.drop_contaminated(docs_table(spark, []), bench(spark)).count() == 0


def test_a_number_alone_is_no_hit():
    windows = D.WindowSet([("1", LONG)])
    assert windows.mark(pa.array([LONG]))[0]["n_hit"] == 20
    windows.text = b"x" * len(windows.text)
    assert windows.mark(pa.array([LONG]))[0]["n_hit"] == 0


def test_words_behind_one_number_are_told_apart(monkeypatch):
    monkeypatch.setattr(D.W, "window_numbers", lambda numbers, length: np.full(max(0, len(numbers) - length + 1), 7, np.uint64))
    windows = D.WindowSet([("1", "a b"), ("2", "b a"), ("3", "a b"), (None, "a b"), ("4", "c")], size=2)
    marks = windows.mark(pa.array(["x a B", "b a b", "c", None, "b c"]))
    assert [m["items"] for m in marks] == [["1", "3"], ["1", "2", "3"], ["4"], [], ["4"]]
    assert [m["n_hit"] for m in marks] == [2, 3, 1, 0, 1]


def test_long_items_are_cut_into_parts_that_keep_every_window(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(40)}" for _ in range(3000))
    items = [(1, long), (2, "w1 w2 w3"), (3, "é" * 500), (4, "-" * 900)]
    texts = [long[5000:5200], "x " + long[-90:], long, "w1 w2 w3 w4", "é" * 500, " ".join(f"w{i % 40}" for i in range(100))]
    got = by_id(D.mark_contamination(docs_table(spark, texts), bench(spark, items), block_bytes=4096))
    marks = [(m["n_words"], m["n_hit"], m["items"]) for m in (got[i]["marks"] for i in range(len(texts)))]
    assert marks == brute(texts, items)


def test_memory_of_a_block_is_bounded_by_its_words():
    rng = np.random.default_rng(1)
    text = " ".join(map(str, rng.integers(10_000, 99_999, 200_000)))
    windows = D.WindowSet([("1", text[: len(text) // 2]), ("2", text[len(text) // 2 :])])
    arrays = [a for k in windows.known.values() for a in vars(k).values() if isinstance(a, np.ndarray)]
    held = len(windows.text) + sum(a.nbytes for a in arrays)
    assert held <= len(text) + 60 * 200_000


def test_contamination_share():
    assert D.ONE_IN == 20 and isinstance(D.is_contaminated(F.lit(1), F.lit(20)), type(F.lit(1)))

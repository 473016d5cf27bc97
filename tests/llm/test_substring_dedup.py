import hashlib
import random
import re
from collections import Counter

import pytest

from riskframe.llm import substring_dedup as S
from tests.llm.helpers import by_id, docs_table, thue_morse_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, size):
    split = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = {k for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for k in range(i, i + size)}
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def random_texts(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["é\x1c\x85", "日本", "|"]
    passage = [r.choice(words) for _ in range(90)]
    texts = []
    for _ in range(40):
        own = [r.choice(words) for _ in range(r.randrange(0, 60))]
        if r.random() < 0.7:
            a, n = r.randrange(50), r.randrange(1, 41)
            at = r.randrange(len(own) + 1)
            own[at:at] = passage[a : a + n]
        texts.append(r.choice([" ", "\n", " \t "]).join(own))
    return [*texts, *texts[:6], None, "", " \n", "same line " * 3000, "x " * 34, "x " * 35, "y " * 36, "z" * 100_000]


@pytest.mark.parametrize("size", [35, 8, 2, 1])
def test_equals_brute_force(spark, size):
    texts = random_texts(size)
    got = by_id(S.count_repeats(docs_table(spark, texts), size))
    for i, (n, removed, kept) in enumerate(brute(texts, size)):
        row = got[i]
        assert (row["n_words"], row["n_removed"]) == (n, removed)
        assert row["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_removal_keeps_other_columns(spark):
    passage = " ".join(f"p{i}" for i in range(10))
    texts = [f"one {passage} two", f"three {passage}", "as  it was", None, passage]
    docs = docs_table(spark, texts, [1, 1, None, 3, 4]).withColumnRenamed("lang", "k1").withColumnRenamed("source", "n_words")
    out = S.remove_repeats(docs, 10)
    assert out.columns == docs.columns
    assert sorted(str(r["text"]) for r in out.collect()) == sorted(["one two", "three", "as  it was", "None", ""])


def test_empty_table(spark):
    assert S.count_repeats(docs_table(spark, [])).count() == 0


def test_levels_double():
    assert S.levels_of(35) == [9, 18, 35]
    for size in range(1, 200):
        levels = S.levels_of(size)
        assert levels[-1] == size and all(b <= 2 * a for a, b in zip(levels, levels[1:]))


def test_words_with_equal_polynomials_are_different_words(spark):
    a, b = thue_morse_words()
    same = " ".join(f"w{i}" for i in range(34))
    texts = [f"{same} {a}", f"{same} {b}"]
    rows = by_id(S.count_repeats(docs_table(spark, texts)))
    assert [rows[i]["n_removed"] for i in range(2)] == [0, 0]

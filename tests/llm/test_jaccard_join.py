import random

import pytest

from riskframe.llm import jaccard_join as J
from tests.llm.helpers import by_id, docs_table, split_words, thue_morse_words


def shingles(text):
    w = split_words(text)
    n = min(5, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute(texts):
    sets = [shingles(t) for t in texts]
    root, links = list(range(len(texts))), [0] * len(texts)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [(links[i], find(i)) for i in range(len(texts))]


def corpus(seed, groups=25):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(r.choice([3, 8, 30, 120]))]
        texts.append(" ".join(base))
        for _ in range(r.randrange(12)):
            copy = list(base)
            for _ in range(r.randrange(0, max(1, len(base) // 25) + 1)):
                copy[r.randrange(len(copy))] = word()
            texts.append(r.choice([" ", ", ", "\n"]).join(copy))
    return [*texts, *texts[:9], None, "", "!?", "One, two", "one two", "ONE TWO THREE", "z " * 60_000, "z z z z z"]


@pytest.mark.parametrize("block_rows", [512, 5])
def test_equals_all_pairs(spark, block_rows):
    texts = corpus(block_rows)
    got = by_id(J.jaccard_join(docs_table(spark, texts), block_rows=block_rows))
    assert [(got[i]["n_links"], got[i]["class_id"]) for i in range(len(texts))] == brute(texts)
    assert all(r["kept"] == (r["class_id"] == i) for i, r in got.items())


def test_one_large_group_gives_a_row_each(spark):
    r = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in (r.randrange(200) for _ in range(150))] + [" ".join(base)] * 300
    got = by_id(J.jaccard_join(docs_table(spark, texts), block_rows=40))
    assert {(x["n_links"], x["class_id"]) for x in got.values()} == {(449, 0)}


def test_ids_may_be_missing_or_repeated(spark):
    texts = ["a b c d e f", "a b c d e f", "q r s t u v", "q r s t u v", "alone one two"]
    out = J.jaccard_join(docs_table(spark, texts, [None, None, 7, 7, None])).collect()
    assert len(out) == 5 and all(r["kept"] for r in out)
    docs = docs_table(spark, [*texts, "Q R S T U V"], [None, 3, 9, 7, None, 8]).withColumnRenamed("lang", "k1").withColumnRenamed("source", "kept")
    kept = J.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["3", "7", "None"]


def test_empty_table(spark):
    assert J.jaccard_join(docs_table(spark, [])).count() == 0


def test_pruning_never_drops_what_could_reach_the_threshold():
    cuts = [J.least_matches(n) for n in J.STEPS]
    assert cuts == sorted(cuts) and all(c < 0.65 * n for c, n in zip(cuts, J.STEPS))
    assert J.posterior(16, 16) > 0.9 and J.posterior(0, 64) < 1e-9


def test_words_with_equal_polynomials_are_different_words(spark):
    rows = by_id(J.jaccard_join(docs_table(spark, list(thue_morse_words()))))
    assert [(rows[i]["n_links"], rows[i]["kept"]) for i in range(2)] == [(0, True)] * 2

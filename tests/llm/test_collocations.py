import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import collocations as C
from tests.llm.helpers import docs_table, lower_ascii


def brute(rows, least=100, top=2000, most=5):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_ascii(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, most + 1):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    often = {k: n for k, n in counts.items() if n >= least}
    out = {}
    for (lang, words), a in often.items():
        inside = lambda other: any(other[i : i + len(words)] == words for i in range(len(other) - len(words) + 1))  # noqa: E731, B023
        if len(words) < 2 or any(
            g == lang and len(w) > len(words) and 100 * b >= 100 * a and inside(w) for (g, w), b in often.items()
        ):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    listed = set()
    for lang, found in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            listed.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return listed


def corpus(seed=1, n=150):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "ÉÉ", "x\x00y", "a\x85", "日本", "b-c", "co"]
    phrases = ["new york city", "of the new", "the the the the", "co b-c 日本 é a\x85"]
    rows = []
    for i in range(n):
        parts = [rng.choice(phrases) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        text = "".join(p + rng.choice([" ", "  ", "\t", " ", " ", ", ", ".", "\n", "; "]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), text))
    return [*rows, ("en", None), ("fr", None), ("fr", ""), ("fr", " .,\n")]


def table(spark, rows, partitions=3):
    docs = docs_table(spark, [t for _, t in rows], partitions=partitions)
    langs = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, l string")
    return docs.join(langs, "doc_id").withColumn("lang", C.F.col("l")).drop("l")


def listed(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("least,top", [(3, 2000), (10, 5), (2, 40)])
def test_equals_brute_force(spark, least, top):
    rows = corpus()
    assert listed(C.collocations(table(spark, rows), least=least, top=top)) == brute(rows, least, top)


def test_full_filters_and_small_blocks_change_nothing(spark, monkeypatch):
    rows = corpus(2)
    whole = listed(C.collocations(table(spark, rows), least=4))
    assert whole == brute(rows, 4) and whole
    assert listed(C.collocations(table(spark, rows), least=4, filter_bits=1)) == whole


def test_colliding_fingerprints_are_told_apart(monkeypatch):
    """With one fingerprint for all phrases, or few, texts alone decide."""
    rows = [r for r in corpus(6, 25) if r[1]]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([r[1] for r in rows])], ["lang", "text"])

    class Sent:
        value = {level: C.FrequentFilter(4) for level in (1, 2, 3)}

    for f in Sent.value.values():
        f.bytes[:] = 255

    def phrases():
        packed = list(C._texts(5, Sent)(iter([batch, batch])))
        found = [tuple(r.values()) for b in C._add_up(3)(iter(packed)) for r in b.to_pylist()]
        assert len(found) == len(set(found))
        return set(found)

    whole = phrases()
    assert len(whole) > 50
    monkeypatch.setattr(C, "HELD_PHRASES", 1)
    assert phrases() == whole
    exact = C.Block.fingerprints
    monkeypatch.setattr(C.Block, "fingerprints", lambda self, m: exact(self, m) % np.uint64(2))
    assert phrases() == whole


def test_long_texts_are_worked_on_in_parts_between_pieces():
    rng = random.Random(5)
    text = "".join(rng.choice(["ab ", "c", "d\t", "e. ", "fé, ", "\n"]) for _ in range(5000)) + "z" * 300
    for limit in (7, 50, 400, 10**6):
        batch = pa.RecordBatch.from_arrays([pa.array(["x", "y", "x"]), pa.array([text, None, "a b"])], ["lang", "text"])
        counts = Counter()
        for block in C.blocks(iter([batch]), limit):
            for m in (1, 2, 3):
                for at in block.places(m):
                    words = [block.data[block.words.starts[k] : block.words.ends[k]].tobytes().decode() for k in range(at, at + m)]
                    counts[block.names[block.group[at]], " ".join(words)] += 1
        want = Counter()
        for lang, t in (("x", text), ("x", "a b")):
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
                words = piece.replace("\t", " ").split(" ")
                words = [w for w in words if w]
                for m in (1, 2, 3):
                    want.update((lang, " ".join(words[i : i + m])) for i in range(len(words) - m + 1))
        assert counts == want


def test_filter_has_the_first_bits_of_each_fingerprint(spark):
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**C.FINGERPRINT_BITS, 3000, dtype=np.uint64)
    frame = spark.createDataFrame([(int(f),) for f in fp.view(np.int64)], "fp long")
    for bits in (3, 17, 22):
        found = C.FrequentFilter.of(frame, bits)
        want = np.zeros(1 << bits, bool)
        want[fp >> np.uint64(C.FINGERPRINT_BITS - bits)] = True
        assert (np.unpackbits(found.bytes, bitorder="little")[: 1 << bits].astype(bool) == want).all()
        assert found.holds(fp).all()


def test_gathered_counts_are_handed_on(spark, monkeypatch):
    rows = corpus(3)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([r[1] for r in rows])], ["lang", "text"])

    class Sent:
        value: dict = {}

    def total():
        out = Counter()
        for b in C._count(range(1, 2), Sent)(iter([batch, batch])):
            for part, low, n in zip(*[b[c].to_pylist() for c in ("part", "low", "n")]):
                for fp, count in zip(low, n, strict=True):
                    out[part, fp] += count
        return sum(out.values()), len(out)

    whole = total()
    monkeypatch.setattr(C, "GATHERED", 1)
    assert total() == whole


def test_scores_beyond_64_bits_are_exact(spark):
    phrases = [("en", "", 9_000_000_000_000_000), ("en", "a", 8_000_000_000_000_001), ("en", "b", 7_000_000_000_000_003), ("en", "a b", 6_000_000_000_000_007)]
    frame = spark.createDataFrame(phrases, "lang string, phrase string, n long")
    a, n, left, right = 6_000_000_000_000_007, 9_000_000_000_000_000, 8_000_000_000_000_001, 7_000_000_000_000_003
    assert [tuple(r) for r in C.rank_phrases(frame).collect()] == [("en", 1, "a b", a, left, right, n, 1000 * a * n // (left * right))]


def test_empty_tables_and_clashing_columns(spark):
    assert C.collocations(docs_table(spark, [])).count() == 0
    assert C.collocations(docs_table(spark, [None, "", "a b"])).count() == 0
    rows = corpus(4)
    docs = table(spark, rows).withColumnRenamed("source", "phrase").withColumnRenamed("doc_id", "n").withColumnRenamed("n_chars", "fp")
    docs = docs.withColumnRenamed("text", "a`b.c").withColumnRenamed("lang", "rank")
    assert listed(C.collocations(docs, group="rank", text="a`b.c", least=4)) == brute(rows, 4)

import heapq
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskframe.llm import huffman, queries
from riskframe.session import scratch_path
from tests.conftest import DATA
from tests.llm.helpers import docs_table

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def optimal_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=2, max_size=60))
def test_lengths_are_optimal_and_limited(counts):
    counts = np.array(counts)
    free = huffman.code_lengths(counts, 40)
    assert int((free * counts).sum()) == optimal_cost(counts.tolist())
    short = huffman.code_lengths(counts, 6)
    assert short.max() <= 6 and sum(2.0 ** -b for b in short) <= 1
    assert (short * counts).sum() >= (free * counts).sum()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), min_size=1, max_size=1500), min_size=1, max_size=4))
def test_codes_round_trip(texts):
    flat = np.concatenate([np.array(t) for t in texts])
    ids, n = np.unique(flat, return_counts=True)
    book = huffman.Codebook(ids, huffman.code_lengths(n, 12))
    counts = np.array([len(t) for t in texts])
    data, starts, inside = book.encode(flat, counts)
    first = np.cumsum(counts) - counts
    marks, sizes = [], []
    for f, c, s in zip(first, counts, starts):
        for a in range(0, c, 7):
            marks.append(inside[f + a] + 8 * s)
            sizes.append(min(7, c - a))
    assert (book.decode(data, np.array(marks), np.array(sizes)) == flat).all()


TEXTS = [
    "Hello  World's it's\n\n tabs\tend", "", None, " ", "é NFC é ÀÉ ß İ ŉ", "日本語 123 😀", "a" * 30_000, "word " * 20_000,
    "\x00\x1c\x85x y　z", "H̱ T̈ İ Å. k̈, Word. WORD, x.'s a.. b ., c.\n.d e,\tf", "<|endoftext|> x<|startoftext|>y <|EndOfText|>", "don't 'S 'Ll", "̈ x ̈", "x", "x",
]


def expected(rows, tokenizer):
    out, start = [], 0
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block", [1, 1 << 18])
def test_files_equal_the_library(spark, tokenizer, monkeypatch, block):
    monkeypatch.setattr(huffman, "BLOCK_IDS", block)
    path = scratch_path(spark, "tokens")
    ids = [5, 3, 9, -4, 0, 12, 7, 100, 101, 55, 56, 57, 2**40, -(2**41), 58]
    huffman.write_tokens(docs_table(spark, TEXTS, ids), path, PATH)
    got = sorted((tuple(r)[:4] for r in huffman.read_tokens(spark, path, with_ids=False).collect()), key=lambda r: r[1])
    assert got == expected(sorted(zip(ids, TEXTS)), tokenizer)


def test_hot_ids_null_ids_and_real_ids(spark, tokenizer):
    ids = [None, 1, 7, 7, 7, 7, 7, 7, 7, 7, 7, 7, 9, 9, 9]
    path = scratch_path(spark, "tokens")
    huffman.write_tokens(docs_table(spark, TEXTS, ids), path, PATH, shards=6)
    rows = sorted(huffman.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted(ids, key=lambda i: -1 if i is None else i)
    assert [r["start"] for r in rows] == list(np.cumsum([0, *[r["n_tokens"] for r in rows[:-1]]]))
    want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in TEXTS)
    assert sorted(list(r["ids"]) for r in rows) == want
    assert len({r["shard"] for r in spark.read.parquet(f"{path}/blocks").filter("array_contains(doc_ids, 7)").collect()}) > 1


def test_empty_table_and_clashing_columns(spark):
    path = scratch_path(spark, "tokens")
    huffman.write_tokens(docs_table(spark, []).withColumnRenamed("lang", "shard").withColumnRenamed("source", "tie"), path, PATH)
    assert huffman.read_tokens(spark, path).count() == 0


def test_query_equals_the_library(spark, tokenizer):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect())
    got = sorted((tuple(r) for r in queries.op7_token_files(spark, DATA).collect()), key=lambda r: r[1])
    assert got == expected(rows, tokenizer)


def test_ids_equal_the_library_added_tokens_included(tokenizer):
    with open(PATH, encoding="utf-8") as f:
        encoder = huffman.WordTokenizer.of(f.read())
    texts = [t or "" for t in TEXTS]
    got = encoder.encode([t.encode() for t in texts])
    assert [list(g) for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert {49406, 49407} <= {int(i) for i in got[TEXTS.index("<|endoftext|> x<|startoftext|>y <|EndOfText|>")]}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abzAZ\u00c9\u00e9\u00df\u00ff\u00b5\u00aa\u00d7\u0130\u0958\u212a\u0301\u0131\u4e2d1' ,.!<|>\n\t", max_size=40), max_size=6))
def test_ids_equal_the_library_on_any_mix_of_letters(texts):
    tokenizer = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as f:
        encoder = huffman.WordTokenizer.of(f.read())
    got = encoder.encode([t.encode() for t in texts])
    assert [list(g) for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgotten_pieces_are_learned_again(tokenizer, monkeypatch):
    monkeypatch.setattr(huffman, "REMEMBERED", 6)
    with open(PATH, encoding="utf-8") as f:
        encoder = huffman.WordTokenizer(f.read())
    texts = ["one two, three four", "five one six! seven", "", "two eight nine ten \u00c9t\u00e9", "one two three, four five"]
    for t in texts * 2:
        assert encoder.encode([t.encode()])[0].tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert len(encoder.number) <= 12

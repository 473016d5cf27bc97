import hashlib
import json

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskframe.llm import queries, word_bpe
from tests.conftest import DATA
from tests.llm.helpers import by_id, docs_table

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return word_bpe.ForcedCutBpe(f.read())


TEXTS = [
    "Hello  World's it's\n\n tabs\tend", "", None, " ", "é NFC é ÀÉ ß İ ŉ", "日本語 123 😀", "a" * 30_000, "word " * 20_000,
    "\x00\x1c\x85x y　z \x7f\x01", "H̱ T̈ İ Å. k̈, Word. WORD, x.'s a.. b ., c.\n.d e,\tf", "<|endoftext|> x <|startoftext|>",
    "a<|endoftext|>'s<|ENDOFTEXT|> <|endoftext|", "don't 'S 'Ll ''s ,'ve'd", "̈ x ̈", "x", "x", "qzxj" * 700, "ΟΔΟΣ ΑΣ Σ",
    "é́<|endoftext|>́x", "x'saab'", "\U000e0001 ǅ ῼ ⅷ ½ ٣",
]


def check(row, text, library):
    ids = library.encode(text or "", add_special_tokens=False).ids
    assert row["n_tokens"] == len(ids)
    assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_equals_the_library(spark, library):
    docs = docs_table(spark, TEXTS)
    coded = word_bpe.encode(docs, PATH, keep=("doc_id", "lang"), decoded="decoded")
    rows = by_id(word_bpe.decode(coded.withColumn("listed", word_bpe.listed()), PATH))
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(np.frombuffer(rows[i]["ids"], "<u4")) == ids == list(rows[i]["listed"])
        assert rows[i]["decoded"] == rows[i]["text"] == library.decode(ids, skip_special_tokens=False)


ALPHABET = st.one_of(
    st.sampled_from(["'", "s", "ve", " ", "\n", "<|endoftext|>", "<|", "th", "ing", "qz", "é", "ß", "A", "́", "1", ".", "...", "xx", "aa"]),
    st.characters(codec="utf-8"),
)


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=40).map("".join))
def test_any_text_equals_the_library(encoder, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got = encoder.encode([text.encode()])[0]
    assert list(np.frombuffer(got, "<u4")) == ids
    assert encoder.decode(got) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abehinorst", min_size=1, max_size=30), min_size=1, max_size=30))
def test_rounds_heap_and_library_agree(encoder, library, words):
    raw = [w.encode() for w in words]
    inside = encoder.encode_words(raw)
    assert inside == [np.array(library.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    symbols, first = encoder.cut(raw)
    ends = [*first[1:], len(symbols)]
    by_heap = [i for a, b in zip(first, ends) for i in encoder._by_heap(encoder.id_of[symbols[a:b]].tolist())]
    assert by_heap == encoder.merge(symbols, first)[0].tolist()


def test_cuts_stand_where_no_token_has_the_pair(encoder):
    symbols, first = encoder.cut([b"qzhello", b"world"])
    assert 7 in first  # the end of a word
    assert len(first) > 2  # and some pair inside a word that no token holds
    letters = {b: c for c, b in word_bpe.byte_letters().items()}
    with open(PATH, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    for at in first[1:]:
        if symbols[at - 1] < 256:
            pair = letters[symbols[at - 1]] + letters[symbols[at] % 256] + ("</w>" if symbols[at] >= 256 else "")
            assert not any(pair in t and (symbols[at] < 256 or t.endswith(pair)) for t in vocab)


def test_forgetting_changes_nothing(monkeypatch, encoder, library):
    monkeypatch.setattr(word_bpe, "REMEMBERED", 1)
    for text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(np.frombuffer(encoder.encode([(text or "").encode()])[0], "<u4")) == ids


def test_repeated_and_missing_ids_empty_table_and_other_columns(spark):
    docs = docs_table(spark, ["a b", "a b", "c", None], [7, 7, None, None])
    docs = docs.withColumnRenamed("lang", "row").withColumnRenamed("source", "a`b.c").withColumnRenamed("n_chars", "ids")
    coded = word_bpe.encode(docs, PATH, keep=("doc_id", "row", "a`b.c"), output="tokens")
    assert coded.columns == ["doc_id", "row", "a`b.c", "tokens"]
    assert sorted((r["doc_id"] or 0, len(r["tokens"])) for r in coded.collect()) == [(0, 0), (0, 4), (7, 8), (7, 8)]
    assert word_bpe.encode(docs_table(spark, []), PATH).count() == 0


def test_other_files_are_refused():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        word_bpe.ForcedCutBpe(f.read())


def test_query_equals_the_library(spark, library):
    got = by_id(queries.op13_forced_cut_bpe(spark, DATA))
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        check(got[r["doc_id"]], r["text"], library)
